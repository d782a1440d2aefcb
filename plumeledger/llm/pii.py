"""Personal data in whole texts, by weak supervision; DataFrame functions only.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay. Further
candidates (key-like tokens, digit groups, spelled-out addresses) are judged as follows:

1. Regex, gazetteer and context labelers vote for, against or not at all on every candidate
   and on every base span.
2. Expectation-maximisation estimates how reliable each labeler is. It needs only the number
   of candidates per pattern of votes, of which there are at most ``3 ** LABELERS``.
3. The resulting probabilities train the final span classifier, a naive Bayes model over a
   few small categorical features, from the same counts by feature value.
4. Candidates that the classifier scores at ``THRESHOLD`` or more and that overlap no base
   span and no earlier candidate are added.

A span's place comes from splitting the text at the pattern: the running sums of the lengths
of the pieces between the matches and of the matches are its offsets. No row is shuffled but
the vote counts, so hot sources or copies have no effect. Patterns are written so that each
run of characters is scanned once, also in very long texts: possessive repetitions, and
matches that may only begin where a run begins or where the last match ended.

Defined results: a null text is an empty one and has no spans; without candidates nothing is
learned and nothing added; repeated rows are judged alike; input columns may have any names
but those that begin with ``__pii_``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

BASE = ("email", "ip", "card", "phone")
EXTRA = ("address", "number", "secret")
KINDS = (*BASE, *EXTRA)
THRESHOLD = 0.9

#: The base patterns, restated so that no run of characters is scanned more than once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "number": r"(?<![0-9(])\(?[0-9][0-9 ().-]{7,}",
    "secret": r"[A-Za-z0-9_+/-]{16,}",
}
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_CONTEXT = 24

#: Gazetteers of words that stand before personal data, and before other long numbers.
WORDS_FOR = (
    "account api_key apikey bearer call card contact e-mail email fax iban key login mail mobile "
    "passwd password phone pin pwd secret ssn tel telephone token"
).split()
WORDS_AGAINST = (
    "chapter commit doi edition figure isbn issn license line no nr page pp revision rfc section "
    "sha table version vol"
).split()


def _guard(kind: str) -> Column:
    text = F.col("__pii_text")
    if kind == "email":
        return text.contains("@")
    if kind == "phone":
        return text.contains("+")
    if kind == "address":
        return text.contains("at)") | text.contains("at]")
    return text.rlike("[0-9]")


def _scan(values: Column, size: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running values of an array, in as many passes as ``size`` has binary digits.

    A pass merges every element with the one ``2 ** k`` places before it. To append to an array
    one by one would copy it each time, which no text with very many matches survives.
    """
    passes = F.when(size > 1, F.sequence(F.lit(0), F.length(F.bin((size - 1).cast("long"))) - 1)).otherwise(F.array())

    def step(done: Column, k: Column) -> Column:
        back = lambda i: F.get(done, i - F.call_function("shiftleft", F.lit(1), k))
        return F.transform(done, lambda x, i: F.when(back(i).isNull(), x).otherwise(merge(back(i), x)))

    return F.aggregate(passes, values, step)


def _running_sum(values: Column, size: Column) -> Column:
    return _scan(values, size, lambda before, x: before + x)


def _located(pieces: Column, hits: Column) -> Column:
    """Matches with their code-point and byte offsets and the text around them.

    An end is the running sum of the lengths of what stands between the matches and of the
    matches themselves.
    """
    n = F.size(hits)
    of = lambda length: F.zip_with(F.slice(pieces, 1, n), hits, lambda x, y: length(x) + length(y))
    zipped = F.arrays_zip(
        hits.alias("hit"),
        F.slice(pieces, 1, n).alias("before"),
        F.slice(pieces, 2, n).alias("after"),
        _running_sum(of(F.char_length), n).alias("end"),
        _running_sum(of(F.octet_length), n).alias("to"),
    )
    return F.transform(
        zipped,
        lambda x: F.struct(
            (x["end"] - F.char_length(x["hit"])).alias("start"), x["end"].alias("end"),
            (x["to"] - F.octet_length(x["hit"])).alias("from"), x["to"].alias("to"), x["hit"].alias("hit"),
            F.right(x["before"], F.lit(_CONTEXT)).alias("before"), F.left(x["after"], F.lit(8)).alias("after"),
        ),
    )


def _valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return n.between(10, 15)
    if kind == "number":
        return n >= 9
    if kind == "secret":
        return hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 2).when(no, 0).otherwise(1)


def _votes(kind: str, x: Column) -> list[Column]:
    """2 for, 0 against, 1 abstains. The number of labelers is the same for every kind."""
    hit, before, after = x["hit"], F.lower(x["before"]), x["after"]
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
    share = digits / F.char_length(hit)
    base = F.lit(kind in BASE)
    shaped = {
        "secret": hit.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{16,}|gh[pousr]_.*|xox[abp]-.*|sk-.*)$"),
        "number": hit.rlike(r"^(?:\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"),
    }.get(kind, F.lit(True))
    wordy = hit.rlike(r"^[A-Za-z]+(?:[_/+-]+[A-Za-z]*[0-9]{0,4})*+$") if kind == "secret" else ~shaped & ~base
    gap = r"\W{0,6}$"
    listed = before.rlike(rf"(?:^|\W)(?:{'|'.join(WORDS_FOR)}){gap}")
    other = before.rlike(rf"(?:^|\W)(?:{'|'.join(WORDS_AGAINST)}){gap}")
    assigned = before.rlike(r"[=:]\s*[\"']?$")
    inside = before.rlike(r"[A-Za-z0-9_/.+-]$") | after.rlike(r"^(?:[A-Za-z0-9_/+-]|\.[A-Za-z0-9])")
    if kind == "secret":
        mixed, plain = share.between(0.1, 0.9), hit.rlike("[a-z]{8,}|[A-Z]{12,}")
    elif kind == "number":
        mixed, plain = digits.between(9, 15), digits > 15
    else:
        mixed, plain = F.lit(True), F.lit(False)
    return [_vote(shaped | base, wordy), _vote(listed, other), _vote(assigned, inside), _vote(mixed & ~plain, plain)]


LABELERS = 4


def _features(kind: str, x: Column) -> list[Column]:
    """Small categories, numbered from 0 within each feature."""
    hit = x["hit"]
    n = F.char_length(hit)
    share = F.length(F.regexp_replace(hit, "[^0-9]", "")) / n
    edge = lambda c: (
        F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike("^[\"'=:(\\[]"), 2).when(c.rlike("^[A-Za-z0-9]"), 3).otherwise(4)
    )
    letters = F.when(hit.rlike("[a-z]"), 1).otherwise(0) + F.when(hit.rlike("[A-Z]"), 2).otherwise(0)
    size = F.when(n < 12, 0).when(n < 16, 1).when(n < 20, 2).when(n < 32, 3).when(n < 64, 4).otherwise(5)
    return [
        F.lit(KINDS.index(kind)), size, F.floor(share * 4).cast("int"), letters,
        edge(F.right(x["before"], F.lit(1))), edge(x["after"]),
        F.when(hit.rlike("[a-z]{8,}|[A-Z]{12,}"), 1).otherwise(0),
    ]


def _checked(kind: str) -> Callable[[Column], Column]:
    return lambda x: _valid(kind, x["hit"])


def _judged(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), x["start"], x["end"], x["from"], x["to"],
        F.array(*_votes(kind, x)).alias("votes"), F.array(*_features(kind, x)).alias("features"),
    )


def annotate(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus ``__pii_base`` (start, kind number, end, and the byte
    offsets ``from`` and ``to``) and ``__pii_found``: base spans and candidates with their
    votes and features."""
    df = docs.withColumn("__pii_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    none = "array<struct<kind:int,start:int,end:int,from:int,to:int,votes:array<int>,features:array<int>>>"
    for kind, pattern in PATTERNS.items():
        guard = _guard(kind)
        df = df.withColumn("__pii_hits", F.when(guard, F.regexp_extract_all("__pii_text", F.lit(pattern), F.lit(0))))
        some = F.size(F.coalesce("__pii_hits", F.array())) > 0
        df = df.withColumn("__pii_pieces", F.when(some, F.split("__pii_text", pattern, -1)))
        df = df.withColumn("__pii_at", F.when(some, _located(F.col("__pii_pieces"), F.col("__pii_hits"))))
        if kind == "number":  # a group ends with its last digit
            df = df.withColumn("__pii_at", F.transform("__pii_at", _trimmed))
        valid = F.transform(F.filter("__pii_at", _checked(kind)), _judged(kind))
        df = df.withColumn(f"__pii_{kind}", F.coalesce(valid.cast(none), F.array().cast(none)))
    df = df.withColumn("__pii_found", F.concat(*[f"__pii_{kind}" for kind in KINDS]))
    base = F.filter("__pii_found", lambda x: x["kind"] < len(BASE))
    df = df.withColumn(
        "__pii_base",
        F.array_sort(F.transform(base, _span)),
    )
    return df.drop("__pii_text", "__pii_hits", "__pii_pieces", "__pii_at", *[f"__pii_{kind}" for kind in KINDS])


def _span(x: Column) -> Column:
    return F.struct(x["start"], x["kind"], x["end"], x["from"], x["to"])


def _trimmed(x: Column) -> Column:
    hit = F.regexp_replace(x["hit"], "[^0-9]+$", "")
    return F.struct(
        x["start"].alias("start"), (x["start"] + F.char_length(hit)).alias("end"),
        x["from"].alias("from"), (x["from"] + F.octet_length(hit)).alias("to"), hit.alias("hit"), x["before"].alias("before"),
        F.left(F.concat(F.substr(x["hit"], F.char_length(hit) + 1), x["after"]), F.lit(8)).alias("after"),
    )


@dataclass
class Model:
    """Reliabilities ``P(vote | class)`` per labeler, and log ratios of the span classifier."""

    prior: float = 0.5
    votes: list[list[list[float]]] = field(default_factory=list)
    bias: float = -10.0
    weights: list[dict[int, float]] = field(default_factory=list)


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[Model, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over vote patterns; also each pattern's probability.

    It starts from the share of votes for among those cast, so "for" keeps its meaning.
    """
    belief = {}
    for votes in counts:
        yes, no = votes.count(2), votes.count(0)
        belief[votes] = (yes + 0.5) / (yes + no + 1)
    model = Model()
    for _ in range(rounds):
        total = sum(counts.values())
        mass = sum(n * belief[v] for v, n in counts.items())
        model.prior = min(0.99, max(0.01, (mass + 1) / (total + 2)))
        model.votes = []
        for k in range(LABELERS):
            table = [[1.0] * 3, [1.0] * 3]
            for votes, n in counts.items():
                table[1][votes[k]] += n * belief[votes]
                table[0][votes[k]] += n * (1 - belief[votes])
            model.votes.append([[x / sum(row) for x in row] for row in table])
        for votes in counts:
            odds = math.log(model.prior / (1 - model.prior))
            for k, vote in enumerate(votes):
                odds += math.log(model.votes[k][1][vote] / model.votes[k][0][vote])
            belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return model, belief


def train(annotated: DataFrame) -> Model:
    """Reliabilities and classifier from the candidates of ``annotate``.

    What reaches the driver is one count per pattern of votes, feature and value: fewer than
    3,000 rows, however large the corpus.
    """
    found = annotated.select(F.explode("__pii_found").alias("x"))
    values = found.select(F.col("x.votes").alias("votes"), F.posexplode("x.features").alias("k", "value"))
    rows = values.groupBy("votes", "k", "value").agg(F.count("*").alias("n")).collect()
    if not rows:
        return Model()
    rows.sort(key=lambda r: (r["k"], r["value"], r["votes"]))
    counts: dict[tuple[int, ...], int] = {}
    for r in rows:
        if r["k"] == 0:  # every candidate has one value of each feature
            counts[tuple(r["votes"])] = counts.get(tuple(r["votes"]), 0) + r["n"]
    model, belief = reliabilities(counts)
    yes = sum(n * belief[votes] for votes, n in counts.items())
    no = sum(counts.values()) - yes
    model.bias = math.log((yes + 1) / (no + 1))
    for k in range(1 + max(r["k"] for r in rows)):
        sums: dict[int, list[float]] = {}
        for r in rows:
            if r["k"] == k:
                p = belief[tuple(r["votes"])]
                pair = sums.setdefault(r["value"], [0.5, 0.5])
                pair[0] += r["n"] * (1 - p)
                pair[1] += r["n"] * p
        model.weights.append(
            {value: math.log(a / (yes + 1)) - math.log(b / (no + 1)) for value, (b, a) in sums.items()}
        )
    return model


def _probability(model: Model, features: Column) -> Column:
    odds = F.lit(model.bias)
    for k, weights in enumerate(model.weights):
        table = F.create_map(*[F.lit(y) for value, w in sorted(weights.items()) for y in (value, w)])
        odds = odds + F.coalesce(F.element_at(table, features[k]), F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def _apart(ordered: Column) -> Column:
    """Of spans in order, the first, then always the next that begins behind the last one kept.

    Where that next span stands follows for all spans at once from the ends sorted among the
    starts; the places kept are those reached from the first, found by doubling the jumps.
    """
    n = F.size(ordered)
    event = lambda at, start, place: F.struct(
        at.alias("at"), F.lit(start).alias("start"), place.cast("int").alias("place")
    )
    events = F.array_sort(
        F.concat(
            F.transform(ordered, lambda x, i: event(x["start"], 1, i)),
            F.transform(ordered, lambda x, i: event(x["end"], 0, i)),
        )
    )
    passed = _running_sum(F.transform(events, lambda e: e["start"]), 2 * n)
    ends = F.filter(F.arrays_zip(events.alias("e"), passed.alias("next")), lambda y: y["e"]["start"] == 0)
    jumps = F.array_sort(F.transform(ends, lambda y: F.struct(y["e"]["place"].alias("place"), y["next"].alias("next"))))
    jumps = F.transform(jumps, lambda y: y["next"])
    passes = F.sequence(F.lit(0), F.length(F.bin(n.cast("long"))))

    def step(done: Column, _: Column) -> Column:
        to = lambda i: F.coalesce(F.get(done["jumps"], i), F.lit(2**31 - 1))
        more = F.filter(F.transform(done["places"], to), lambda i: i < n)
        return F.struct(
            F.concat(done["places"], more).alias("places"), F.transform(done["jumps"], to).alias("jumps")
        )

    first = F.struct(F.array(F.lit(0)).alias("places"), jumps.alias("jumps"))
    places = F.aggregate(passes, first, step, lambda d: F.array_sort(d["places"]))
    return F.when(n > 0, F.transform(places, lambda i: F.get(ordered, i)))


def spans(annotated: DataFrame, model: Model) -> DataFrame:
    """``annotated`` with ``__pii_spans``: base and added spans by start, then kind.

    Whether a candidate meets a base span follows from two running values over all spans by
    start: the largest end of a base span before it, and the smallest start of one behind.
    """
    base = F.col("__pii_base")
    sure = F.filter(
        "__pii_found", lambda x: (x["kind"] >= len(BASE)) & (_probability(model, x["features"]) >= THRESHOLD)
    )
    found = annotated.withColumn("__pii_sure", F.transform(sure, _span))
    both = F.array_sort(F.concat(base, "__pii_sure"))
    found = found.withColumn("__pii_both", F.when(F.size("__pii_sure") > 0, both))
    of_base = lambda x: x["kind"] < len(BASE)
    n = F.size("__pii_both")
    ends = F.transform("__pii_both", lambda x: F.when(of_base(x), x["end"]).otherwise(0))
    starts = F.transform(F.reverse("__pii_both"), lambda x: F.when(of_base(x), x["start"]).otherwise(2**31 - 1))
    near = F.arrays_zip(
        F.col("__pii_both").alias("x"),
        _scan(ends, n, F.greatest).alias("behind"),
        F.reverse(_scan(starts, n, F.least)).alias("ahead"),
    )
    clear = lambda y: (y["behind"] <= y["x"]["start"]) & (y["ahead"] >= y["x"]["end"])
    free = F.transform(F.filter(near, lambda y: ~of_base(y["x"]) & clear(y)), lambda y: y["x"])
    found = found.withColumn("__pii_free", free)
    # Candidates of one kind are apart already.
    kinds = F.size(F.array_distinct(F.transform("__pii_free", lambda x: x["kind"])))
    apart = F.when(kinds > 1, _apart(F.col("__pii_free"))).otherwise(F.col("__pii_free"))
    every = F.when(F.size("__pii_free") > 0, F.array_sort(F.concat(base, apart))).otherwise(base)
    return found.withColumn("__pii_spans", every).drop("__pii_sure", "__pii_both", "__pii_free")


def as_text(spans_column: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans_column, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with its spans; the model is trained on ``docs`` unless one is given.

    The annotation is written once: training and judging read it, instead of matching all
    patterns twice in one expression of a size that is slow to plan and to compile.
    """
    annotated = Scratch(docs.sparkSession, "pii").stage(annotate(docs))
    return spans(annotated, model or train(annotated))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all columns stay.

    Spans that overlap are replaced as one, named after the first. ``n_chars``, where there
    is one, is set anew; a null text stays null. Texts are cut by byte offsets, which take no
    count of the characters before them.
    """
    found = find(docs)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text").cast("string")
    reach = _scan(F.transform("__pii_spans", lambda x: x["to"]), F.size("__pii_spans"), F.greatest)
    last = F.array_max(F.transform("__pii_spans", lambda x: x["to"]))
    zipped = F.arrays_zip(F.col("__pii_spans").alias("x"), F.concat(F.array(F.lit(0)), reach).alias("done"))
    cuts = F.filter(zipped, lambda y: y["done"] <= y["x"]["from"])
    piece = lambda b, at, end: F.substr(b, at + 1, end - at).cast("string")
    # The bytes are bound to a name by an array of one: they are made once, not once per span.
    clean = F.transform(
        F.array(text.cast("binary")),
        lambda b: F.concat(
            F.array_join(
                F.transform(cuts, lambda y: F.concat(piece(b, y["done"], y["x"]["from"]), F.get(names, y["x"]["kind"]))), ""
            ),
            piece(b, last, F.octet_length(b)),
        ),
    )
    clean = F.when(F.size("__pii_spans") > 0, F.get(clean, F.lit(0))).otherwise(text)
    found = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
