"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong kinds are reported wherever they match: assigned secrets, access identifiers and long
hexadecimal strings.  Weak kinds (a login or account name, an endpoint, a token of mixed
characters) look like ordinary text alone.  A weak part is reported only if a complementary part
lies in its scope: an identifier or an endpoint needs a secret, a secret needs an identifier or
an endpoint, each within ``REACH`` code points.

Positions come from running lengths, counted in blocks (``spans``), so that a text with very many
matches takes time in proportion to them.

The interval join: the parts of a text are placed into cells of ``REACH`` code points; a weak
part looks into its own and the two neighbouring cells.  Parts of one kind do not overlap, so a
cell holds a bounded number of them and the join grows with the parts, not with their square.
It runs once per distinct text with weak parts; copies share the answer, and texts themselves
never cross the network.

Edge cases: a missing or empty text has no spans; rows that repeat have the same spans each; a
missing id stays missing; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.spans import matches, replace
from tidemark.session import durable

REACH = 160

# Fixed values of the base scan.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs of the class are maximal, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

_TOKEN = r"[A-Za-z0-9+/_-]"
ACCOUNT = (
    r"""(?i)(?:access_?key_?id|client_?id|account(?:_?id)?|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9_.@+-]{3,})"""
)
ENDPOINT = r"""(?i)(?:[a-z][a-z0-9+]{1,15}://[^\s"'<>]+|(?:host|endpoint|server|base_?url)["']?\x20*[:=]\x20*["']?[a-z0-9.-]{4,}(?::[0-9]{2,5})?)"""
MIXED = (
    rf"(?<!{_TOKEN})(?={_TOKEN}*[0-9])(?={_TOKEN}*[a-z])(?={_TOKEN}*[A-Z])"
    rf"{_TOKEN}{{20,}}={{0,2}}(?!{_TOKEN})"
)

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "account", "endpoint", "mixed")
STRONG = KINDS[:3]
# What a part stands for; account/endpoint go with a secret, a secret with either.
ROLE = {"assign": "secret", "access": "name", "hex": "secret", "account": "name", "endpoint": "place", "mixed": "secret"}

_SPANS = "array<struct<start:int,end:int,kind:int>>"


def spans(text: Column, pattern: str, kind: int, least: str | None = None) -> Column:
    """Leftmost non-overlapping matches as (start, end, kind); ``least`` is the least length of group 2."""
    found = matches(text, pattern)
    if least:
        found = F.filter(found, lambda m: F.char_length(F.regexp_extract(m["hit"], pattern, 2)) >= int(least))
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"))).cast(_SPANS)


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def _listed(column: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined, by start and then kind."""
    by_start = F.array_sort(F.transform(F.col(column), lambda s: F.struct(s["start"], s["kind"], s["end"])))
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(by_start, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ","
    )


def _linked(parts: DataFrame) -> DataFrame:
    """(text_key, start, end, kind) of weak parts that have a complementary part within reach.

    ``parts`` holds text_key, start, end, kind, each once.
    """
    role = F.element_at(F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLE[k]))), F.col("kind"))
    parts = parts.withColumn("role", role)
    first, last = F.floor((F.col("start") - REACH) / REACH), F.floor((F.col("end") + REACH) / REACH)
    # A long part covers many cells; it is listed in each, so that the join is on equal cells.
    cells = parts.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / REACH), F.floor(F.col("end") / REACH))))
    weak = parts.where(F.col("kind") >= len(STRONG)).withColumn("cell", F.explode(F.sequence(first, last)))
    x, y = weak.alias("x"), cells.alias("y")
    near = (F.col("y.start") <= F.col("x.end") + REACH) & (F.col("y.end") >= F.col("x.start") - REACH)
    fits = (F.col("x.role") == "secret") != (F.col("y.role") == "secret")
    apart = (F.col("y.start") >= F.col("x.end")) | (F.col("y.end") <= F.col("x.start"))
    same = (F.col("x.text_key") == F.col("y.text_key")) & (F.col("x.cell") == F.col("y.cell"))
    linked = x.join(y, same & near & fits & apart, "left_semi").select("text_key", "start", "end", "kind").distinct()
    # What a strong span covers as a whole is not reported again.
    strong = cells.where(F.col("kind") < len(STRONG)).alias("y")
    x = linked.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / REACH), F.floor(F.col("end") / REACH)))).alias("x")
    over = same & (F.col("y.start") <= F.col("x.start")) & (F.col("y.end") >= F.col("x.end"))
    covered = x.join(strong, over, "left_semi").select("text_key", "start", "end", "kind").distinct()
    return linked.join(covered, ["text_key", "start", "end", "kind"], "left_anti")


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``base`` and ``found``: arrays of (start, end, kind) of the strong
    kinds and of all reported kinds; kind counts in ``KINDS``."""
    body = text_or_empty(text)
    named = [F.col(c).alias(f"__{i}") for i, c in enumerate(keep)]
    rows = docs.select(*named, body.alias("text"))
    base = F.concat(
        spans(F.col("text"), ASSIGN, 0, "6"), spans(F.col("text"), ACCESS, 1), spans(F.col("text"), HEX, 2)
    )
    weak = F.concat(
        spans(F.col("text"), ACCOUNT, 3), spans(F.col("text"), ENDPOINT, 4), spans(F.col("text"), MIXED, 5)
    )
    held = [f"__{i}" for i in range(len(keep))]
    seen = rows.select(*held, base.alias("base"), weak.alias("weak"), F.md5("text").alias("md5"))
    # Only texts with a weak part need the join; the others have no key.
    seen = durable(seen.withColumn("text_key", F.when(F.size("weak") > 0, F.col("md5"))).drop("md5"))
    asked = seen.where("text_key is not null")
    parts = asked.select("text_key", F.concat("base", "weak").alias("p")).dropDuplicates(["text_key"])
    parts = parts.select("text_key", F.inline("p"))
    linked = _linked(parts).groupBy("text_key").agg(F.collect_set(F.struct("start", "end", "kind")).alias("more"))
    more = asked.join(linked, "text_key", "left").select(
        *held, "base", F.concat("base", F.coalesce("more", F.array().cast(_SPANS))).alias("found")
    )
    plain = seen.where("text_key is null").select(*held, "base", F.col("base").alias("found"))
    return plain.unionByName(more).select(*(F.col(h).alias(c) for h, c in zip(held, keep)), "base", "found")


def report(scanned: DataFrame) -> DataFrame:
    """Counts and lists of the spans: n_assign, n_access, n_hex, base_sha256 and spans."""
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(STRONG)]
    kept = [c for c in scanned.columns if c not in ("base", "found")]
    return scanned.select(
        *kept, *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("found").alias("spans")
    )


def redact(text: Column, found: Column, mark: str = "<SECRET>") -> Column:
    """``text`` with every span of ``found`` replaced by ``mark``; overlapping spans become one."""
    return replace(text, found, mark)
