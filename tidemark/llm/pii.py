"""Personal data in texts, in DataFrame functions only.

Regular expressions propose spans.  Checks confirm them: parts of an address, the number of
digits, the Luhn sum of cards, the remainder by 97 of account numbers.  What a kind is worth by its
form, by a checksum and by words that stand nearby adds up to a score in per cent.  The four base
kinds are reported whatever their score; the others, whose form alone says little, only from
``LEAST`` on and where they touch no base span.

Texts stay where they are read: no shuffle, no join, no key.  The patterns cannot run back over
what they have passed (possessive runs, starts only where a run begins), so that a text takes
time in proportion to its length even if it is one run of digits; offsets are counted in blocks
(``spans``).

Edge cases: a missing or empty text has no spans; rows that repeat have the same spans each; a
missing id stays missing; an empty table gives no rows; other columns are not touched and may
have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.spans import before, let, matches, replace

NEAR = 40  # characters on either side in which context words count
LEAST = 60  # per cent from which a span of a further kind is reported

# The four base patterns, with possessive runs.  A run is entered at its first
# character or where the match before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGITS = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"
SOCIAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
LOCAL = r"(?<![0-9+])\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,5}){1,4}(?![0-9])"

# Characters of an account number by country.
ACCOUNT_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20, "LB": 28, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22,
}


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        v = F.substring(digits, i, F.lit(1)).cast("int")
        twice = v * 2 - F.when(v > 4, 9).otherwise(0)
        return F.when((F.char_length(digits) - i) % 2 == 1, twice).otherwise(v)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether the remainder by 97 of an account number, its first four characters last, is 1."""
    moved = F.concat(F.substring(account, F.lit(5), F.char_length(account)), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return (F.when(c >= 65, rest * 100 + c - 55).otherwise(rest * 10 + c - 48) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.char_length(moved)), F.lit(0), step) == 1


def _small(part: Column) -> Column:
    """Whether a string of digits is at most 255."""
    own = F.ltrim(part, F.lit("0"))
    return (F.char_length(own) < 3) | ((F.char_length(own) == 3) & (own <= "255"))


def _digits_between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda m: F.char_length(digits_of(m["hit"])).between(low, high)


def _card(low: int, high: int) -> Callable[[Column], Column]:
    # A run of more than 2 * high characters has too many digits.
    return lambda m: (F.char_length(m["hit"]) < 2 * high) & _digits_between(low, high)(m) & luhn(digits_of(m["hit"]))


def _account_end(m: Column) -> Column:
    """Characters of the account number at the start of a proposal; 0 if there is none."""
    hit = m["hit"]
    lengths = F.create_map(*(F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair))
    need = F.try_element_at(lengths, F.substring(hit, 1, 2))
    pattern = F.concat(F.lit(r"^(?:\x20?[A-Z0-9]){"), need.cast("string"), F.lit("}"))

    def ends(own: Column) -> Column:
        after = F.substring(F.concat(hit, m["right"]), F.char_length(own) + 1, F.lit(1))
        good = ~after.rlike("[A-Za-z0-9]") & mod97(F.replace(own, F.lit(" "), F.lit("")))
        return F.when((own != "") & good, F.char_length(own)).otherwise(0)

    return F.when(need.isNull(), 0).otherwise(let(F.call_function("regexp_extract", hit, pattern, F.lit(0)), ends))


@dataclass(frozen=True)
class Kind:
    """A kind of personal data; form, checksum and context are in per cent."""

    name: str
    pattern: str
    form: int
    checksum: int
    context: int
    words: str  # alternatives of context words, in lower case
    check: Callable[[Column], Column] | None = None
    length: Callable[[Column], Column] | None = None  # characters that count; 0: none


KINDS = (
    Kind("email", EMAIL, 80, 0, 20, "e-?mail|mail|contact|write|reply|kontakt|correo|courriel"),
    Kind("ip", IP, 50, 0, 30, "ip|address|host|server|client|login|adresse|direcci[oó]n",
         lambda m: F.forall(F.split(m["hit"], r"\."), _small)),
    Kind("card", DIGITS, 30, 40, 30, "card|credit|debit|visa|master|pay|karte|carte|tarjeta", _card(16, 19)),
    Kind("phone", PHONE, 60, 0, 30, "phone|tel|call|mobile|fax|telefon|appel|llama", _digits_between(8, 15)),
    Kind("iban", ACCOUNT, 30, 60, 10, "iban|account|bank|konto|compte|cuenta", None, _account_end),
    Kind("ssn", SOCIAL, 40, 0, 40, "ssn|social|security|insurance|taxpayer"),
    Kind("short_card", DIGITS, 20, 30, 30, "card|credit|debit|amex|express|diners|pay|karte|carte|tarjeta", _card(13, 15)),
    Kind("local_phone", LOCAL, 30, 0, 30, "phone|tel|call|mobile|fax|telefon|appel|llama", _digits_between(7, 12)),
)
BASE = 4  # the first kinds are reported always
_SPANS = "array<struct<start:int,end:int,kind:int,score:int>>"


def _spans_of(text: Column, number: int) -> Column:
    """Confirmed spans of one kind as (start, end, kind, score)."""
    kind = KINDS[number]
    words = rf"(?i)(?<![\p{{L}}])(?:{kind.words})"

    def span(m: Column) -> Column:
        context = F.when(m["left"].rlike(words) | m["right"].rlike(words), kind.context).otherwise(0)
        end = m["start"] + kind.length(m) if kind.length else m["end"]
        return F.struct(
            m["start"].alias("start"), end.alias("end"), F.lit(number).alias("kind"),
            F.least(F.lit(100), F.lit(kind.form + kind.checksum) + context).alias("score"),
        )

    found = matches(text, kind.pattern, NEAR)
    if kind.check:
        found = F.filter(found, kind.check)
    spans = F.transform(found, span)
    if number >= BASE:
        spans = F.filter(spans, lambda s: (s["end"] > s["start"]) & (s["score"] >= LEAST))
    return spans.cast(_SPANS)


def _clear_of_base(base: Column, more: Column) -> Column:
    """The spans of ``more`` that touch none of ``base``, found from running ends and starts."""
    far = F.lit(2**31 - 1)
    listed = F.concat(base, more)
    ordered = F.array_sort(F.transform(listed, lambda s: F.struct(s["start"], s["kind"], s["end"], s["score"])))

    def clear(all_: Column) -> Column:
        ends = F.transform(all_, lambda s: F.when(s["kind"] < BASE, s["end"]).otherwise(0))
        starts = F.reverse(F.transform(all_, lambda s: F.when(s["kind"] < BASE, s["start"]).otherwise(far)))
        reached, ahead = before(ends, F.lit(0), F.greatest), F.reverse(before(starts, far, F.least))
        around = F.arrays_zip(all_.alias("s"), reached.alias("a"), ahead.alias("b"))
        free = F.filter(
            around, lambda x: (x["s"]["kind"] >= BASE) & (x["s"]["start"] >= x["a"]) & (x["s"]["end"] <= x["b"])
        )
        return F.transform(free, lambda x: F.struct(*(x["s"][c].alias(c) for c in ("start", "end", "kind", "score"))))

    return F.when(F.size(more) == 0, more).otherwise(let(ordered, clear)).cast(_SPANS)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``base`` and ``found``: arrays of (start, end, kind, score) of the
    base kinds and of all reported kinds, ordered by kind and start; kind counts in ``KINDS``."""
    held = [f"__{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(h) for c, h in zip(keep, held)), text_or_empty(text).alias("text"))
    seen = rows.select(
        *held,
        F.concat(*(_spans_of(F.col("text"), i) for i in range(BASE))).alias("base"),
        F.concat(*(_spans_of(F.col("text"), i) for i in range(BASE, len(KINDS)))).alias("more"),
    )
    found = F.concat("base", _clear_of_base(F.col("base"), F.col("more"))).alias("found")
    ordered = F.array_sort(F.transform("found", lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"])))
    spans = F.transform(ordered, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "end", "kind", "score"))))
    kept = [F.col(h).alias(c) for h, c in zip(held, keep)]
    return seen.select(*held, "base", found).select(*kept, "base", spans.alias("found"))


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == number


def _listed(spans: str) -> Column:
    name = F.array(*(F.lit(k.name) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def report(scanned: DataFrame) -> DataFrame:
    """Counts and lists of the spans: n_email, n_ip, n_card, n_phone, base_sha256, spans and scores."""
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{KINDS[i].name}") for i in range(BASE)]
    kept = [c for c in scanned.columns if c not in ("base", "found")]
    scores = F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",")
    return scanned.select(
        *kept, *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("found").alias("spans"), scores.alias("scores"),
    )


def redact(text: Column, found: Column, mark: str = "<PII>") -> Column:
    """``text`` with every span of ``found`` replaced by ``mark``; overlapping spans become one."""
    return replace(text, found, mark)
