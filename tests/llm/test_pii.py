import random
import re
import time

from pyspark.sql import functions as F
from llm_fixtures import no_docs, odd_docs, plan_of  # noqa: F401

from plumeledger.llm import pii

#: The base patterns as the contract states them.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base(text):
    out = []
    for kind, (name, pattern) in enumerate(STATED.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True,
                "ip": name != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[name]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def texts():
    rng = random.Random(5)
    parts = [*"aZ09.@-+% ()_é😀", "1.2.3.4", "4539578763621486", "a@b.c", "+1 (555) 123-4567", "4539 5787 6362 1486"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2500)]
    long = ["1" * 60_000, "a" * 50_000 + "@", "1 " * 20_000, "a." * 20_000 + "@" + "b." * 20_000 + "c", "+" + "1" * 30_000]
    return [*made, None, "", *long, "1.2.3.4.5.6.7.8 256.1.1.1 00001.1.1.1", "a@b.com_x@c.org"]


def test_base_spans_same_as_stated(spark):
    made = texts()
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(4)
    rows = pii.find(df).select("doc_id", "__pii_base", "__pii_spans").collect()
    for r in rows:
        spans = [(x["start"], x["kind"], x["end"]) for x in r["__pii_base"]]
        assert spans == base(made[r["doc_id"]]), made[r["doc_id"]][:200]
        every = [(x["start"], x["kind"], x["end"]) for x in r["__pii_spans"]]
        assert every == sorted(every) and set(spans) <= set(every)


def test_secrets_are_added_and_plain_text_is_left(spark):
    rng = random.Random(1)
    key = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    plain = "Under license version 2.0 the well-known-and-long-name-2 costs 1200 on page 4."
    rows = [(i, f'so token = "{key()}" and mail a{i}@b.org ends') for i in range(60)] + [(100 + i, plain) for i in range(60)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    listed = {r["doc_id"]: r["s"] for r in found.select("doc_id", pii.as_text(F.col("__pii_spans")).alias("s")).collect()}
    # A base span inside a key stays, and then the key is not added.
    alone = [i for i in range(60) if len(base(rows[i][1])) == 1]
    assert len(alone) > 50 and all(listed[i].startswith("secret:12:52,email:") for i in alone)
    assert all(listed[100 + i] == "" for i in range(60))


def test_reliabilities():
    """Three labelers are right nine times in ten, one guesses."""
    rng = random.Random(3)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple(2 * (truth if rng.random() < 0.9 else not truth) for _ in range(3)) + (rng.choice([0, 2]),)
        counts[votes] = counts.get(votes, 0) + 1
    model, belief = pii.reliabilities(counts)
    assert abs(model.prior - 0.4) < 0.05
    assert all(abs(model.votes[k][1][2] - 0.9) < 0.05 for k in range(3)) and abs(model.votes[3][1][2] - 0.5) < 0.06
    assert belief[2, 2, 2, 0] > 0.95 and belief[0, 0, 0, 2] < 0.05


def test_redaction(spark, odd_docs, no_docs):
    rows = [(1, "é mail a@b.org, ip 1.2.3.4!", "x"), (2, None, "x"), (3, "clean", "x"), (4, "+1 (555) 123-4567", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").withColumn("n_chars", F.length("text"))
    found = pii.redact(df)
    assert found.schema == df.schema
    assert sorted(tuple(r)[:2] for r in found.collect()) == [(1, "é mail [EMAIL], ip [IP]!"), (2, None), (3, "clean"), (4, "[PHONE]")]
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in found.collect())
    same = [c for c in odd_docs.columns if c != "n_chars"]
    assert sorted(map(repr, pii.redact(odd_docs).select(same).collect())) == sorted(map(repr, odd_docs.select(same).collect()))
    assert pii.redact(no_docs).collect() == []


def test_plan_is_native(spark, odd_docs):
    plan = plan_of(pii.redact(odd_docs))
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_spans_apart_same_as_one_after_the_other(spark):
    rng = random.Random(8)
    rows = []
    for n in [0, 1, 2, 3, 300] + [rng.randint(2, 12) for _ in range(200)]:
        starts = sorted(rng.randint(0, 3 * n) for _ in range(n))
        rows.append([{"start": s, "end": s + rng.randint(1, 9)} for s in starts])
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x array<struct<start:int,end:int>>")
    for r in df.select("x", pii._apart(F.col("x")).alias("kept")).collect():
        expected, at = [], 0
        for x in r["x"]:
            if x["start"] >= at:
                expected.append(x)
                at = x["end"]
        assert (r["kept"] or []) == expected


def test_overlapping_spans_same_as_plain_version(spark):
    """Added spans clear of base spans and of each other; redaction by code points."""
    rng = random.Random(9)
    parts = [*" é😀.-", "token = ", "123456789-", "abcdefgh12345678", "x (at) y.com ", "call 555 123 4567 890 ", "a@b.org "]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(4)
    annotated = pii.annotate(df)
    model = pii.Model(bias=10.0)  # every candidate is sure
    for r in pii.spans(annotated, model).collect():
        base_spans = [(x["start"], x["kind"], x["end"]) for x in r["__pii_base"]]
        sure = sorted((x["start"], x["kind"], x["end"]) for x in r["__pii_found"] if x["kind"] >= len(pii.BASE))
        added, at = [], 0
        for s, kind, e in sure:
            if all(e <= x or y <= s for x, _, y in base_spans) and s >= at:
                added.append((s, kind, e))
                at = e
        found = [(x["start"], x["kind"], x["end"]) for x in r["__pii_spans"]]
        assert found == sorted(base_spans + added)
        raw = r["text"].encode()
        assert all(raw[x["from"] : x["to"]].decode() == r["text"][x["start"] : x["end"]] for x in r["__pii_spans"])
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    for r in pii.find(df).collect():
        out, at = "", 0
        for x in r["__pii_spans"]:
            if x["start"] >= at:
                out += r["text"][at : x["start"]] + f"[{pii.KINDS[x['kind']].upper()}]"
            at = max(at, x["end"])
        assert redacted[r["doc_id"]] == out + r["text"][at:]


def test_time_grows_with_the_number_of_matches(spark):
    seconds = {}
    for n in (100, 10_000, 40_000):
        text = " ".join(f"a{i}@b.org so token = deadbeef{i:032x}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        (row,) = pii.redact(df).collect()
        seconds[n] = time.perf_counter() - start
        assert row["text"] == " ".join(["[EMAIL] so token = [SECRET]"] * n)
    assert seconds[40_000] < 5 * seconds[10_000]
