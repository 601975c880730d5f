"""Quality rules with risk-controlled thresholds.

Every document gets a few statistics; a statistic above its stratum's cutoff
rejects the document. Cutoffs come from labelled holdouts and are put in force
one after another, in an order that is fixed beforehand. A step holds if an
exact binomial (Clopper-Pearson) test shows that all cutoffs in force with it
*together* reject at most a stated share of the good documents of the stratum.
The first step that doesn't hold ends its stratum's chain, so no correction is
due inside a chain (fixed-sequence testing); over the strata the error is
divided (Bonferroni). A stratum without enough labels has no cutoffs.

DataFrame functions only.

Defined cases: a null text has no words; a null stratum is a stratum of its
own; several labels of one document count once, and it is good if any of them
says so; labels of unknown documents are ignored; repeated documents are
judged each; with no labels at all, only the base rule rejects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import WORD_BREAK, settled, words

SYMBOLS = "#*$%&|<>"

#: A window's place in its text takes this many bits, its hash the others; windows of longer texts are compared as words.
PLACE_BITS = 20


@dataclass(frozen=True)
class Risk:
    """What the cutoffs may cost and which are tried.

    ``false_rejection``: the share of good documents of a stratum that all
    statistics together may reject; ``error``: the chance that the cutoffs of
    any stratum break that promise. ``cutoffs`` are put in force statistic by
    statistic in the order given, each from loose to strict: put first what is
    trusted most.
    """

    false_rejection: float = 0.01
    error: float = 0.05
    cutoffs: dict[str, list[float]] = field(default_factory=lambda: {
        "symbol_ratio": [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0],
        "dup_line_ratio": [0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
        "repeat_ratio": [0.1, 0.15, 0.2, 0.25, 0.3, 0.4],
        "long_words": [7.0, 8.0, 9.0, 10.0, 12.0, 15.0],
        "short_words": [-4.0, -3.5, -3.0, -2.5, -2.0],
    })


def _twins(s: str) -> Column:
    """Those of the sorted longs ``s`` that share their hash bits with a neighbour."""
    def near(x, k, d):
        return F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(s, k + d), PLACE_BITS)

    return F.filter(F.col(s), lambda x, k: near(x, k, -1) | near(x, k, 1))


def _repeat_words(hashed: str, spelled: str) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    ``hashed`` holds sorted longs (upper hash bits, place) of windows that
    share their bits with another, ``spelled`` sorted (words, place) of all
    windows where these can't tell (see ``_unsure``), else nothing.
    """
    def near(x, k, d):
        return x.t == F.get(spelled, k + d).t

    by_words = F.transform(F.filter(spelled, lambda x, k: near(x, k, -1) | near(x, k, 1)), lambda x: x.i)
    by_hash = F.transform(hashed, lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))
    return F.aggregate(
        F.sort_array(F.when(F.size(spelled) > 0, by_words).otherwise(by_hash)),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a.n + F.least(p - a["last"], F.lit(3))).alias("n")),
        lambda a: a.n)


def _unsure(w: str, twins: str) -> Column:
    """Whether windows with equal hash bits differ in words, or places don't fit their bits."""
    def window(i):
        return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]

    def place(x):
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def differs(x, k):
        after = F.get(twins, k + 1)
        return (F.shiftright(x, PLACE_BITS) == F.shiftright(after, PLACE_BITS)) & ~_same(window(place(x)), window(place(after)))

    return (F.size(w) >= (1 << PLACE_BITS)) | (F.size(F.filter(F.col(twins), differs)) > 0)


def _same(a: list[Column], b: list[Column]) -> Column:
    return (a[0] == b[0]) & (a[1] == b[1]) & (a[2] == b[2])


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (longs).

    Lines without a word are no lines here. Every row is measured by itself:
    no shuffle. Settle the result before filtering it: a filter is pushed
    down into these expressions and would compute them several times over.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, body.alias("_text"), words(F.col(text)).alias("_w"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    mask = -(1 << PLACE_BITS)
    windows = F.transform(
        F.slice(F.col("_w"), 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)).bitwiseAND(F.lit(mask))
        .bitwiseOR(i.cast("long")))
    df = df.select(
        *keep, "_w",
        lines.alias("_lines"),
        F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.sort_array(windows).alias("_s"))
    df = df.select(*keep, "_w", "_lines", "n_symbols", _twins("_s").alias("_t"))
    spelled = F.sort_array(F.transform(
        F.slice(F.col("_w"), 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda x, i: F.struct(F.concat_ws(" ", x, F.get("_w", i + 1), F.get("_w", i + 2)).alias("t"), i.alias("i"))))
    df = df.select(*keep, "_w", "_lines", "n_symbols", "_t", F.when(_unsure("_w", "_t"), spelled).otherwise(
        F.array().cast("array<struct<t:string,i:int>>")).alias("_u"))
    return df.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_t", "_u").alias("n_repeat_words"))


def statistics() -> dict[str, Column]:
    """The statistics by name; higher is worse, null where there are no words."""
    n = F.nullif(F.col("n_words"), F.lit(0).cast("long"))
    lines = F.nullif(F.col("n_lines"), F.lit(0).cast("long"))
    return {
        "symbol_ratio": F.col("n_symbols") / n,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": -(F.col("word_chars") / n),
    }


def within_risk(k: Column, n: Column, risk: float, error: Column) -> Column:
    """Whether P(Binomial(n, risk) <= k) <= error, i.e. the exact upper bound on the rate is at most ``risk``.

    The tail is the largest term (its logarithm summed factor by factor) times
    one plus the falling ratios of the terms below it; only k < n * risk can
    pass, so other rows cost nothing.
    """
    odds = risk / (1 - risk)
    steps = F.when((k > 0) & (k < n * F.lit(risk)), F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>"))
    log_top = F.aggregate(steps, n * F.log1p(F.lit(-risk)),
                          lambda a, i: a + F.log((n - i + 1) / i * F.lit(odds)))
    rest = F.aggregate(
        F.reverse(steps), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, i: F.struct((a.term * i / ((n - i + 1) * F.lit(odds))).alias("term"),
                              (a.total + a.term * i / ((n - i + 1) * F.lit(odds))).alias("total")),
        lambda a: a.total)
    return (k < n * F.lit(risk)) & (log_top + F.log(rest) <= F.log(error))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _steps(risk: Risk) -> list[tuple[str, float]]:
    """The cutoffs in the order in which they are put in force."""
    return [(s, float(c)) for s, tried in risk.cutoffs.items() for c in sorted(tried, reverse=True)]


def cutoffs(measures: DataFrame, labels: DataFrame, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """(stratum, one column per statistic): the strictest cutoff in force, or null.

    ``measures`` (settled) needs doc_id and ``stratum``; ``labels`` (doc_id, quality).
    The holdout is every labelled good document that passes the base rule.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("_quality")).where("_quality = 1")
    stats, steps = statistics(), _steps(risk)
    # The step at which a document is rejected for the first time; later steps reject it too.
    first = F.least(F.lit(len(steps)), *[F.when(stats[s] > c, i) for i, (s, c) in enumerate(steps)], F.lit(len(steps)))
    held = measures.where(~base_failed()).join(good.select("doc_id"), "doc_id", "left_semi").select(
        F.col(stratum).alias("stratum"), first.alias("_first"))
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_first") <= i).alias(f"over_{i}") for i in range(len(steps))])
    strata = counts.agg(F.count(F.lit(1)).alias("strata"))
    error = F.lit(risk.error) / F.col("strata")
    # strata holds one row: among how many chains the error is divided.
    tested = counts.join(F.broadcast(strata), F.lit(True)).select("stratum", F.array(
        *[within_risk(F.col(f"over_{i}"), F.col("n"), risk.false_rejection, error) for i in range(len(steps))],
        F.lit(False)).alias("_holds"))
    in_force = F.array_position("_holds", False) - 1
    return tested.select("stratum", in_force.alias("_in_force")).select("stratum", *[
        F.coalesce(*[F.when(F.col("_in_force") > i, F.lit(c)) for i, (t, c) in reversed(list(enumerate(steps))) if t == s],
                   F.lit(None).cast("double")).alias(s) for s in stats])


#: Strata up to this many are broadcast; more are joined by a shuffle.
BROADCAST_STRATA = 10_000


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every document.

    The measures of all texts are computed once and settled (a few longs a
    document); the cutoffs then come from the labelled rows among them.
    """
    m = settled(measured(docs.select("doc_id", "text", F.col(stratum).alias("stratum")), keep=("doc_id", "stratum")))
    cut = settled(cutoffs(m, labels, "stratum", risk))
    limits = cut.select(F.col("stratum").alias("_stratum"), *[F.col(s).alias(f"max_{s}") for s in statistics()])
    if cut.count() <= BROADCAST_STRATA:
        limits = F.broadcast(limits)
    over = F.lit(False)
    for s, c in statistics().items():
        over = over | F.coalesce(c > F.col(f"max_{s}"), F.lit(False))
    return m.join(limits, m["stratum"].eqNullSafe(limits["_stratum"]), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"))


def oracle(risk: Risk = Risk()) -> str:
    """The same rows in DuckDB SQL: windows by unnesting, binomial tails term by term."""
    stats = {
        "symbol_ratio": "n_symbols / nullif(n_words, 0)", "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "repeat_ratio": "n_repeat_words / nullif(n_words, 0)", "long_words": "word_chars / nullif(n_words, 0)",
        "short_words": "-(word_chars / nullif(n_words, 0))"}
    steps, p = _steps(risk), risk.false_rejection
    first = "least(" + ", ".join([str(len(steps)), *[f"CASE WHEN {stats[s]} > {c} THEN {i} ELSE {len(steps)} END" for i, (s, c) in enumerate(steps)]]) + ")"
    counts = ", ".join(f"CAST(count_if({first} <= {i}) AS BIGINT) AS over_{i}" for i in range(len(steps)))

    def passes(i: int) -> str:
        return (f"over_{i} < n * {p} AND list_sum(list_transform(range(0, over_{i} + 1), lambda i: exp(lgamma(n + 1) - "
                f"CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln({1 - p})))) "
                f"<= {risk.error} / strata")

    holds = "list_position([" + ", ".join([*[f"({passes(i)})" for i in range(len(steps))], "false"]) + "], false) - 1"
    limits = ", ".join(
        "coalesce(" + ", ".join([*[f"CASE WHEN in_force > {i} THEN {c}::DOUBLE END"
                                   for i, (t, c) in reversed(list(enumerate(steps))) if t == s], "NULL::DOUBLE"]) + f") AS max_{s}"
        for s in stats)
    over = " OR ".join(f"coalesce({e} > max_{s}, false)" for s, e in stats.items())
    failed = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    word = r"[^\x20\x09-\x0D]"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{word}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS l
  FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d) u),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g) x WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) t(o) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
counts AS (SELECT lang, count(*) AS n, {counts} FROM m WHERE NOT {failed} AND doc_id IN (SELECT doc_id FROM good) GROUP BY lang),
cut AS (SELECT lang, {limits} FROM (
  SELECT lang, {holds} AS in_force FROM counts, (SELECT count(*) AS strata FROM counts) s) h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,
       NOT {failed} AND NOT ({over}) AS kept
FROM m LEFT JOIN cut ON m.lang IS NOT DISTINCT FROM cut.lang
"""
