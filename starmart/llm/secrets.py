"""Secrets: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order models over the characters of keys and identifiers are trained from labelled
samples, one on random strings and one on ordinary identifiers. Training is a grouping of
character pairs; the models come to one array of log ratios, a constant in the scan's
expressions. The scan finds fixed patterns, and adds long runs that the random model explains
better by a margin. All of it is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.arrays import matches, running
from starmart.llm.common import let, scratch, smallest_present

# The base patterns, the group whose length counts, and the least length.
KINDS = {
    "assign": (
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        1, 12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    # Runs are matched from their start, so asking for 16 or more drops just the shorter ones.
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{16}"
ORDER = [*KINDS, "markov"]
RUN = r"[A-Za-z0-9+/_=-]"
LEAST_RUN = 20
SIZE = 128
SMOOTHING = 0.5
# A run is taken for random only if that is 1,000 times as likely as an identifier.
MARGIN = math.log(1000)
SAMPLE_ROWS = 2000

SPAN = "array<struct<start:bigint,end:bigint,kind:int>>"


# ---- training -------------------------------------------------------------------


def samples(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled strings (value, is_random) from at most `most` labelled documents.

    The documents are those of docs, of good quality, with the smallest hashes. Their words, alone and
    joined in pairs as identifiers are, are ordinary; their digests, in hexadecimal and base64,
    are random, and so are the values of the fixed patterns they hold.
    """
    chosen = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    chosen = smallest_present(chosen, docs, most, scratch(docs.sparkSession, "secrets-labels"))
    some = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    some = some.join(F.broadcast(chosen), "doc_id")
    digest = F.unhex(F.sha2("text", 512))
    secret = [F.regexp_extract_all("text", F.lit(p), F.lit(g)) for p, g, _ in KINDS.values()]
    random = some.select(F.explode(F.concat(
        F.array(F.base64(digest), F.substring(F.sha2("text", 512), 1, 64)),
        *[_at_least(s, n) for s, (_, _, n) in zip(secret, KINDS.values(), strict=True)],
    )).alias("value"), F.lit(True).alias("is_random"))
    plain = F.regexp_extract_all("text", F.lit(r"[A-Za-z]{3,15}"), F.lit(0))
    words = some.select(plain.alias("w")).select(
        F.explode(F.transform("w", lambda w, i: F.concat_ws("_", w, F.get(F.col("w"), i + 1))))
        .alias("value"), F.lit(False).alias("is_random"))
    return random.unionAll(words)


def _at_least(values: Column, size: int) -> Column:
    return F.filter(values, lambda v: F.length(v) >= size)


def train(labelled: DataFrame) -> list[float]:
    """Log ratios by pair of character codes, from labelled strings (value, is_random).

    Characters outside ASCII share code 0. Only counts per label and pair reach the driver, at
    most 2 * 128 * 128. Without samples of a label its model is uniform; with none, all is 0.
    """
    codes = F.transform(F.split("value", ""), lambda c: F.ascii(c))
    rows = labelled.where("value is not null and is_random is not null")
    rows = rows.select("is_random", codes.alias("c"))
    pairs = rows.select("is_random", F.explode(F.transform(
        F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))),
        lambda a, i: F.when(a < SIZE, a).otherwise(0) * SIZE
        + F.when(F.get(F.col("c"), i + 1) < SIZE, F.get(F.col("c"), i + 1)).otherwise(0),
    )).alias("pair"))
    counts = {True: [0.0] * SIZE * SIZE, False: [0.0] * SIZE * SIZE}
    for row in pairs.groupBy("is_random", "pair").count().collect():
        counts[row["is_random"]][row["pair"]] = float(row["count"])
    used = [i for i in range(SIZE) if chr(i).isalnum() or chr(i) in "+/_=-"]
    out = [0.0] * SIZE * SIZE
    for a in used:
        total = {
            label: sum(n[a * SIZE + b] + SMOOTHING for b in used) for label, n in counts.items()
        }
        for b in used:
            at = a * SIZE + b
            chance = {k: (n[at] + SMOOTHING) / total[k] for k, n in counts.items()}
            out[at] = math.log(chance[True] / chance[False])
    return out


def log_ratio(run: Column, ratios: Column) -> Column:
    """Sum of the log ratios of a run's character pairs."""
    return let(
        F.transform(F.split(run, ""), lambda c: F.ascii(c)),
        lambda codes: F.aggregate(
            F.sequence(F.lit(1), F.size(codes) - 1), F.lit(0.0),
            lambda total, i: total + F.get(ratios, F.get(codes, i - 1) * SIZE + F.get(codes, i)),
        ),
    )


# ---- spans ------------------------------------------------------------------------


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = KINDS[kind]
    found = F.filter(matches(text, pattern, group), lambda m: m["size"] >= least)
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(ORDER.index(kind)).alias("kind")
    ))


def random_runs(text: Column, ratios: Column, margin: float) -> Column:
    runs = matches(text, f"{RUN}{{{LEAST_RUN},}}")
    likely = F.filter(runs, lambda m: log_ratio(m["found"], ratios) > margin)
    return F.transform(likely, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"),
        F.lit(ORDER.index("markov")).alias("kind"),
    ))


def apart(spans: Column) -> Column:
    """Sorted spans without the added ones that overlap a base span.

    Added spans do not overlap each other, so only base ends before and the next span count.
    """
    added = ORDER.index("markov")

    def pick(every: Column, ends: Column) -> Column:
        return F.filter(every, lambda s, i: (s["kind"] != added) | (
            (F.get(ends, i) <= s["start"])
            & (
                F.get(every, i + 1).isNull()
                | (F.get(every, i + 1)["kind"] == added)
                | (F.get(every, i + 1)["start"] >= s["end"])
            )
        ))

    def ends(every: Column) -> Column:
        own = F.transform(every, lambda s: F.when(s["kind"] != added, s["end"]).otherwise(
            F.lit(0).cast("long")))
        return running(own, lambda a, b: F.greatest(a, b), F.lit(0).cast("long"))

    return let(F.array_sort(spans, _by_start), lambda every: let(
        ends(every), lambda e: pick(every, e)
    ))


def _by_start(a: Column, b: Column) -> Column:
    def sign(x: Column, y: Column, rest: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(rest)

    return sign(a["start"], b["start"], sign(a["kind"], b["kind"], F.lit(0)))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def find_secrets(docs: DataFrame, ratios: list[float], margin: float = MARGIN) -> DataFrame:
    """Per row of docs (doc_id, text): base spans counted and hashed, and all spans.

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans); spans are kind:start:end in code
    points, end exclusive, by start and then kind. The model adds spans of kind markov, none of
    which overlaps a base span; base spans of different kinds may overlap.

    Defined cases: NULL and empty texts have no spans. Rows are judged one by one, so equal rows
    give equal rows; a NULL doc_id is kept. No rows give no rows. Other columns are not read.
    """
    # One string constant, split once when the plan is made, instead of thousands of literals.
    table = F.split(F.lit(",".join(f"{r:.6g}" for r in ratios)), ",").cast("array<double>")
    none = F.array().cast(SPAN)
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"_hint": text.rlike(HINT), "_long": text.rlike(f"{RUN}{{{LEAST_RUN}}}")})
    rows = rows.select("doc_id", *[
        F.when(F.col("_hint"), base_spans(text, k)).otherwise(none).cast(SPAN).alias(f"_{k}")
        for k in KINDS
    ], F.when(F.col("_long"), random_runs(text, table, margin)).otherwise(none).cast(SPAN)
        .alias("_markov"))
    base = F.concat(*[F.col(f"_{k}") for k in KINDS])
    some = F.size(base) + F.size("_markov") > 0
    rows = rows.withColumn("_all", F.when(some, apart(F.concat(base, F.col("_markov"))))
                           .otherwise(none))
    added = ORDER.index("markov")
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.filter("_all", lambda s: s["kind"] != added)), 256).alias("base_sha256"),
        joined(F.col("_all")).alias("spans"),
    )
