"""Personal data, hard negatives and conversation repair: brute force, odd rows, long texts, ties."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
from tidemark.llm import conversations, hard_negatives, pii, queries, spans

SF_DIR = "/root/testdata/sf0.001"


def _digits(hit):
    return re.sub("[^0-9]", "", hit)


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda h: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda h: all(int(x) <= 255 for x in h.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda h: 16 <= len(_digits(h)) <= 19 and _luhn(_digits(h))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: 8 <= len(_digits(h)) <= 15),
}


def _base(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text) if ok(m[0])]


def _hash(found):
    return hashlib.sha256(",".join("%s:%d:%d" % x for x in found).encode()).hexdigest()


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op11_pii(spark, SF_DIR).collect()
    assert len(rows) == len(texts) and sum(r["n_email"] + r["n_card"] for r in rows) > 0
    for r in rows:
        found = _base(texts[r["doc_id"]])
        assert r["base_sha256"] == _hash(found)
        assert [r[f"n_{k}"] for k in BASE] == [sum(f[0] == k for f in found) for k in BASE]
        assert {"%s:%d:%d" % f for f in found} <= set(r["spans"].split(","))


def test_base_of_random_texts(spark):
    draw = random.Random(5)
    alphabets = ("0123456789.+@ -()ab_é🙂", "0123456789. -", "ab.@-_%")
    texts = ["".join(draw.choice(a) for _ in range(draw.randint(0, 70))) for a in alphabets for _ in range(700)]
    texts += ["a@b.com_x@c.de", "1.2.3.000255 1.2.3.256 1.2.3.4.5.6.7.8"]
    for r in pii.report(pii.scan(_frame(spark, texts))).collect():
        assert r["base_sha256"] == _hash(_base(texts[r["doc_id"]])), texts[r["doc_id"]]


@pytest.mark.parametrize(
    "text, found, scores",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 AND MORE", "iban:5:32", "100"),
        ("GB82WEST12345698765432.", "iban:0:22", "90"),
        ("DE89 3704 0044 0532 0130 01", "", ""),
        ("my ssn 123-45-6789", "ssn:7:18", "80"),
        ("lot 123-45-6789", "", ""),
        ("call (030) 555-1234", "local_phone:5:19", "60"),
        ("amex card 378282246310005 x", "short_card:10:25", "80"),
        ("part 378282246310005 x", "", ""),
        ("pay by card 4111 1111 1111 1111", "card:12:31", "100"),
        ("call +1 (132) 555-1352", "phone:5:22", "90"),
        ("é🙂 a@b.co", "email:3:9", "80"),
    ],
)
def test_checksums_and_context(spark, text, found, scores):
    row = pii.report(pii.scan(_frame(spark, [text]))).first()
    assert (row["spans"], row["scores"]) == (found, scores)


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (3, "a@b.de", None), (3, "a@b.de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string").select("*", F.lit(1).alias("found"), F.lit(2).alias("__0"))
    got = sorted(map(str, (r["spans"] for r in pii.report(pii.scan(docs)).collect())))
    assert got == ["", "", "email:0:6", "email:0:6"]
    assert pii.report(pii.scan(docs.where("false"))).count() == 0


@pytest.mark.parametrize("text", ["1" * 2_000_000, "a." * 1_000_000, "+1" + " " * 2_000_000, "ab@cd.de 1.2.3.4 " * 60_000])
def test_personal_data_of_long_texts(spark, text):
    row = pii.report(pii.scan(_frame(spark, [text]))).first()
    if "@" in text:
        assert row["base_sha256"] == _hash(_base(text)) and row["n_email"] == 60_000
    else:
        assert row["spans"] == ""


def test_replacing_many_spans(spark):
    text = "x@y.de é +1 (132) 555-1352 " * 20_000
    scanned = pii.scan(_frame(spark, [text, "clean", None]), keep=("doc_id", "text"))
    got = {r[0]: r[1] for r in scanned.select("doc_id", pii.redact(F.col("text"), F.col("found"), "*")).collect()}
    assert got == {0: "* é * " * 20_000, 1: "clean", 2: None}


def test_overlapping_spans_become_one(spark):
    spans_ = F.expr("array(named_struct('start',1,'end',4),named_struct('start',2,'end',3),named_struct('start',3,'end',6),named_struct('start',6,'end',7))")
    assert spark.range(1).select(spans.replace(F.lit("0123456789"), spans_, "*")).first()[0] == "0**789"


@pytest.mark.parametrize("count", [0, 1, 255, 256, 257, 70_000])
def test_running_values(spark, count):
    values = F.transform(F.sequence(F.lit(1), F.lit(max(count, 1))), lambda i: (i * 7919 % 101).cast("int"))
    values = F.slice(values, 1, F.lit(count))
    total = spans.before(values, F.lit(0), lambda a, b: a + b)
    most = spans.before(values, F.lit(0), F.greatest)
    numbers = [i * 7919 % 101 for i in range(1, count + 1)]
    got = spark.range(1).select(total, most).first()
    assert got[0] == [0, *itertools.accumulate(numbers)][:count] and got[1] == [0, *itertools.accumulate(numbers, max)][:count]


def _mined(rows, k=5):
    """Plain ranking of all rows for every anchor."""
    whole = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, l, v in rows if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    late = lambda i: (i is None, i or 0)
    out = []
    for place, (anchor, label, vector) in enumerate(whole):
        if anchor is None or anchor % 100:
            continue
        others = [(sum(a * b for a, b in zip(vector, v)), i, m) for j, (i, m, v) in enumerate(whole) if j != place and len(v) == len(vector)]
        others.sort(key=lambda x: (-x[0], late(x[1])))
        for score, positive, _ in [x for x in others if x[2] == label][:k]:
            fits = [x for x in others if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score][:k]
            out += [(anchor, positive, n + 1, i, score, s) for n, (s, i, _) in enumerate(fits)]
    return sorted(out, key=str)


def _mine(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = hard_negatives.mine(frame, label=F.col("label"), anchor=F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed, grid", [(1, 256), (2, 4), (3, 1)])
def test_mining_equals_ranking_of_all_rows(spark, seed, grid):
    """Coarse grids make many equal scores."""
    draw = np.random.default_rng(seed)
    vectors = np.round(draw.normal(size=(400, 12)) * grid) / grid
    rows = [(i * 10, int(draw.integers(3)), v.tolist()) for i, v in enumerate(vectors)]
    got = _mine(spark, rows)
    assert got and got == _mined(rows)


def test_mining_with_odd_rows(spark):
    ones = [1.0, 0.5]
    rows = [
        (0, 1, ones), (0, 1, ones), (100, 1, ones), (5, 2, ones), (None, 2, ones), (6, None, ones), (7, 2, None),
        (8, 2, [1.0, None]), (9, 2, [float("nan"), 1.0]), (10, 2, [float("inf"), 1.0]), (11, 2, []), (200, 2, []),
        (12, 2, [1.0]), (300, 1, [1.0]), (13, 1, [-1.0, -1.0]), (400, 3, [-1.0, -1.0]), (500, 3, [-1.0, 0.0]),
    ]
    assert _mine(spark, rows) == _mined(rows)
    assert _mine(spark, rows[:0]) == []


def test_bounds_clear_candidates_before_the_last_column():
    draw = np.random.default_rng(0)
    vectors = (draw.normal(size=(5000, 64)) * 100).astype(np.int64)
    labels = draw.integers(0, 2, 5000)
    block = hard_negatives.Block(np.arange(5000), np.arange(5000), np.ones(5000, bool), labels, vectors)
    anchor = vectors[0] * (np.arange(64) < 12)
    seen = []

    def still(lower, upper):
        seen.append(len(lower))
        return upper >= np.partition(lower, -5)[-5]

    alive, score = block.scan(anchor, block.other(int(labels[0])), still)
    assert seen[-1] < seen[0] / 50 and np.array_equal(score, block.columns.T[alive] @ anchor)


def _cheapest(rows, costs, most=2):
    """All edits of rows (role, text, must go, truncated) with up to ``most`` insertions."""
    reroles, deletes, inserts, extra = costs
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(r[2] and e != "D" for r, e in zip(rows, edits)):
            continue
        for more in itertools.product(range(most + 1), repeat=len(rows) + 1):
            if sum(more) > most:
                continue
            own = [x for m, pair in zip(more, [*zip(edits, rows), None]) for x in ([("I", None)] * m + [pair] * (pair is not None))]
            kept = [x for x in own if x[0] != "D"]
            first = 1 if kept and kept[0][0] == "K" and kept[0][1][0][:1] == "s" else 0
            if (len(kept) - first) % 2 or first == len(kept) == 1:
                continue
            wanted = ["user", "assistant"]
            if any(e == "K" and r[0][:1] != "ua"[i % 2] for i, (e, r) in enumerate(kept[first:])):
                continue
            cost = sum({"K": 0, "R": reroles, "D": deletes, "I": inserts}[e] + extra * (e in "KR" and r[3]) for e, r in own)
            lines = [
                f"{r[0] if e == 'K' else wanted[(i - first) % 2]}:{'' if r is None else r[1]}" for i, (e, r) in enumerate(kept)
            ]
            answer = (cost, "".join(e for e, _ in own), hashlib.sha256("\n".join(lines).encode()).hexdigest())
            best = answer if best is None else min(best, answer)
    return best


@pytest.mark.parametrize("costs", [(1, 2, 5, 5), (2, 3, 1, 1), (3, 4, 1, 3), (1, 1, 1, 1)])
def test_repair_is_the_cheapest(monkeypatch, costs):
    for name, value in zip(("REROLE", "DELETE", "INSERT", "TRUNCATED"), costs):
        monkeypatch.setattr(conversations, name, value)
    # The bounds on what a state can be ahead hold for a truncated row, which deletion spares, too.
    ahead = {(0, 3): costs[1], (0, 2): costs[2] + costs[1], (1, 3): 0, (1, 2): costs[2]}
    monkeypatch.setattr(conversations, "AHEAD", ahead)
    draw = random.Random(sum(costs))
    longest, inserts = (4, 2) if costs[2] > 3 else (2, 6)
    for _ in range(150):
        roles = ["system", "user", "assistant", "tool", " "]
        rows = [(draw.choice(roles), draw.choice("ab"), draw.random() < 0.2, draw.random() < 0.2) for _ in range(draw.randint(0, longest))]
        search = conversations.Repair()
        for row in rows:
            search.row(*row)
        assert search.finish() == _cheapest(rows, costs, inserts), rows


def test_undecided_edits_stay_few():
    draw, search, most = random.Random(1), conversations.Repair(), 0
    for _ in range(20_000):
        search.row(draw.choice(["user", "assistant", "system"]), "x", draw.random() < 0.1, draw.random() < 0.1)
        most = max(most, search.held())
    assert most < 400
    search = conversations.Repair()
    for i in range(20_000):
        search.row(("user", "assistant")[i % 2], "x", False, False)
    assert search.held() < 20 and search.finish()[0] == 0


def _conversation(rows):
    """Faults and repair of one conversation's damaged rows, plainly."""
    seen, marked, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        blank, end = not re.search(r"[^\x20\x09-\x0D]", text), re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        faults = [blank, (role, text) in seen, end not in (".", "!", "?")]
        seen.add((role, text))
        first = faults.index(True) if any(faults) else None
        if first is not None:
            counts[first] += 1
        marked.append((role, text, first in (0, 1), first == 2))
    turns = {t for t, _, _ in rows if t is not None}
    lacking = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (lacking, *counts, sum(p not in ("su", "ua", "au") for p in pairs), *_cheapest(marked, (1, 2, 5, 5), most=1))


ODD = [
    (1, 0, "system", "Hi."), (1, 1, "user", "a?"), (1, 1, "user", "a?"), (1, None, None, None), (1, 9, "assistant", "b"),
    (2, None, "user", "x."), (2, None, "user", "x."), (2, 3, None, "x."), (None, None, "user", ""), (None, 4, "user", "q.\x0b "),
    (None, 5, "assistant", "q"), (5, -(2**40), "tool", "é🙂!"), (5, 2**40, "", "\x1c"), (6, 1, "user", "same."), (6, 2, "user", "same."),
    (6, 3, "assistant", "same."), (7, 1, None, None),
]


def _damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


@pytest.mark.parametrize("shift", [0, 7, 23, 41])
def test_repair_of_odd_rows(spark, shift):
    """Shifted ids meet every kind of damage."""
    rows = [(None if c is None else c + 10 * shift, *rest) for c, *rest in ODD]
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, n int")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.damage_and_repair(extra.repartition(3)).collect()}
    late = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    damaged = sorted(_damaged(rows), key=late)
    empty = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damaged if r[0] == conv]
        assert got[conv] == (_conversation(own) if own else empty), conv
    assert len(got) == len({r[0] for r in rows}) and conversations.damage_and_repair(extra.where("false")).count() == 0


def test_a_conversation_of_many_rows_and_a_long_text(spark):
    rows = spark.range(60_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") == 8, F.repeat(F.lit("ä "), 1_000_000)).otherwise(F.concat(F.col("id").cast("string"), F.lit("."))).alias("text"),
    )
    row = conversations.damage_and_repair(rows).collect()
    assert len(row) == 1 and len(row[0]["audit"]) > 50_000 and row[0]["blank"] > 1000


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_conversation_repair"])
def test_matches_sql(spark, name):
    with check.connect("/root/testdata/sf0.01") as duck:
        assert check.compare(contract.queries()[name](spark, "/root/testdata/sf0.01"), contract.oracle_sql()[name], duck) == ""
