"""Secrets in texts: fixed patterns, and character Markov models for strings no pattern knows.

Three patterns give base spans. Beyond them, every long run of key characters is scored by two
first-order Markov models over folded characters, one of random strings, one of ordinary words and numbers;
a run outside the base spans whose log-likelihood ratio is high enough becomes a span of its own. The
models are counted from labelled samples: what the patterns caught, and shorter runs of the same characters
outside it. A share of the ordinary steps is given to shapes of numbers, dates and joined words, so that
what few texts hold is no evidence of a secret.

Everything is a row-local expression over the text: no shuffle, no Python worker. Java's regular
expressions give matches but no places, so a place is the running length of the stretches between
the matches (``split``) and of the matches themselves. The models are one array of log ratios, a
literal of fixed size in the plan.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, the group that has to be long enough, and its least length. For the
# last two, asking for the length within the pattern gives the same matches, as both are maximal runs.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
)
RANDOM = "random"
#: Runs the models judge, and runs they take as ordinary.
RUN = "[A-Za-z0-9+/_=-]{16,}"
WORD = "[A-Za-z0-9+/_=-]{6,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1
#: Share of the ordinary steps that shapes take, and how likely a class follows another in them.
SHAPES = 0.04
FOLLOWS = {
    "start": {"letter": 0.5, "digit": 0.5},
    "letter": {"letter": 0.5, "join": 0.5},
    "digit": {"digit": 0.7, "join": 0.3},
    "join": {"letter": 0.5, "digit": 0.4, "join": 0.1},
}
CLASSES = {"letter": ALPHABET[:26], "digit": ALPHABET[26:36], "join": "/_=-+"}
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,value:string>"


# --- spans ----------------------------------------------------------------------------------------


def _matches(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one pattern, in order; the value is the group that was measured."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
            F.lit(kind).alias("kind"), x["value"].alias("value"),
        )
        out = F.when(F.length(x["value"]) >= least, F.concat(state["out"], F.array(span)))
        return F.struct(end.alias("at"), out.otherwise(state["out"]).alias("out"))

    walked = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("found"), value.alias("value")),
        F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")),
        step,
        lambda state: state["out"],
    )
    return F.when(text.rlike(pattern), walked).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind as listed; null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    found = [_matches(text, rank, *rest) for rank, rest in enumerate(BASE)]
    return F.array_sort(F.concat(*found))


# --- models ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """``ratios``: log P(next | previous) under random less that under ordinary, row by row.

    ``threshold`` is the least sum over a run, in nats.
    """

    ratios: tuple[float, ...]
    threshold: float = 12.0


def _steps(token: Column) -> Column:
    """(previous, next) places in the alphabet from 1; 0 is the start or another character."""
    chars = F.filter(F.split(F.lower(token), ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    before = F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))))
    return F.zip_with(
        before, codes, lambda p, c: F.struct(p.alias("previous"), c.alias("next"))
    )


def _shaped(previous: int, following: int) -> float:
    """Probability of a step within the shapes, by places in the alphabet."""
    of = lambda place: next(k for k, chars in CLASSES.items() if ALPHABET[place - 1] in chars)
    if not following:
        return 0.0
    after = of(following)
    return FOLLOWS[of(previous) if previous else "start"].get(after, 0.0) / len(CLASSES[after])


def train(samples: DataFrame, threshold: float = 12.0, smoothing: float = 0.5) -> Model:
    """Models from ``(token string, random boolean)``.

    The driver receives at most two counts per pair of characters of the alphabet. Without samples of
    a kind its model is uniform, which is also what smoothing pulls rare pairs to.
    """
    # Repeated tokens are one row with their number before they are taken apart.
    tokens = samples.dropna().groupBy("token", "random").agg(F.count("*").alias("n"))
    steps = tokens.select("random", "n", F.explode(_steps(F.col("token"))).alias("step"))
    counts = steps.groupBy("random", "step.previous", "step.next").agg(F.sum("n").alias("n"))
    seen = {(r["random"], r["previous"], r["next"]): r["n"] for r in counts.collect()}
    total: Counter = Counter()
    for (kind, previous, _), n in seen.items():
        total[kind, previous] += n

    def log(kind: bool, previous: int, following: int) -> float:
        n = seen.get((kind, previous, following), 0) + smoothing
        counted = n / (total[kind, previous] + smoothing * SIZE)
        if kind or not any(total.values()):
            return math.log(counted)
        return math.log((1 - SHAPES) * counted + SHAPES * (_shaped(previous, following) + 1 / SIZE) / 2)

    places = range(SIZE)
    ratios = {(p, c): log(True, p, c) - log(False, p, c) for p in places for c in places}
    # Rules and fillings repeat a character, so that is no evidence of a secret.
    ratios |= {(p, p): min(0.0, ratios[p, p]) for p in places}
    return Model(tuple(ratios[p, c] for p in places for c in places), threshold)


def labelled_samples(
    docs: DataFrame, text: str = "text", key: str = "doc_id", max_docs: int | None = 20_000
) -> DataFrame:
    """``(token, random)``: values the base patterns caught, and runs of the rest of the texts.

    Taken from about ``max_docs`` documents, chosen by a hash of key and text, so that fitting costs
    the same at every size; with fewer documents, or None, from all.
    """
    chosen = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    if max_docs is not None:
        bound = int(min(1.0, max_docs / max(1, docs.count())) * (1 << 32))
        chosen = chosen.where(F.pmod(F.xxhash64("key", "text"), F.lit(1 << 32)) < bound)
    rest = F.col("text")
    for _, pattern, *_ in BASE:
        rest = F.regexp_replace(rest, pattern, " ")
    random = F.transform(
        base_spans(F.col("text")), lambda s: F.struct(s["value"].alias("token"), F.lit(True).alias("random"))
    )
    ordinary = F.transform(
        F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(w.alias("token"), F.lit(False).alias("random")),
    )
    return chosen.select(F.explode(F.concat(random, ordinary)).alias("s")).select("s.token", "s.random")


def log_ratio(token: Column, model: Model) -> Column:
    """Sum of the log ratios along a token."""
    ratios = F.split(F.lit(",".join(map(repr, model.ratios))), ",").cast("array<double>")
    return F.aggregate(
        _steps(token),
        F.lit(0.0),
        lambda total, s: total + F.coalesce(F.get(ratios, s["previous"] * SIZE + s["next"]), F.lit(0.0)),
    )


def random_spans(text: Column, base: Column, model: Model) -> Column:
    """Runs outside the base spans that look random; a base span ends a run."""
    runs = _matches(blanked(F.coalesce(text, F.lit("")), base), len(BASE), RANDOM, RUN, 0, 0)
    return F.filter(runs, lambda r: log_ratio(r["value"], model) >= model.threshold)


def blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans, so places stay."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        from_ = F.least(F.greatest(s["start"], state["at"]), s["end"])
        between = F.substr(text, state["at"].cast("int") + 1, (from_ - state["at"]).cast("int"))
        blanks = F.repeat(F.lit(" "), (s["end"] - from_).cast("int"))
        out = F.concat(state["out"], between, blanks)
        return F.when(
            s["end"] > state["at"], F.struct(s["end"].alias("at"), out.alias("out"))
        ).otherwise(state)

    rest = lambda state: F.concat(state["out"], F.substr(text, state["at"].cast("int") + 1))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, rank, end, kind, value), by start.

    ``spans`` holds the base spans and what the models add. Places are code points, the end exclusive.
    Null and empty texts have no span; columns named ``base`` or ``spans`` are replaced.
    """
    kept = docs.drop("base", "spans")
    based = kept.withColumn("base", base_spans(F.col(text)))
    added = random_spans(F.col(text), F.col("base"), model)
    return based.withColumn("spans", F.array_sort(F.concat("base", added)))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping or touching spans replaced by one mask."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        from_ = state["at"].cast("int")
        between = F.substr(text, from_ + 1, (s["start"] - state["at"]).cast("int"))
        new = (s["start"] > state["at"]) | (state["at"] == 0)
        out = F.when(new, F.concat(state["out"], between, F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substr(text, state["at"].cast("int") + 1))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
