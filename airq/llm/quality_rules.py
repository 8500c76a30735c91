"""Quality rules whose cutoffs keep the rate of wrong rejections below a bound, in DataFrame functions only.

Each rule scores a document (higher is worse) and has a grid of cutoffs. A cutoff may be
used in a stratum (a band of text lengths) only if the labelled good documents of that stratum
show, by an exact binomial test, that the rules reject less than ``RISK`` of
them (``joint_cutoffs``): all rules of a stratum are tested together in a fixed order of cutoffs, which
needs no correction within it, and the strata share ``LEVEL``, so that with probability 1 - LEVEL every
stratum loses at most RISK of its good documents. Of the proven cutoffs of a rule the strictest is used; where
none is proven the rule rejects nothing. ``cutoffs`` is the plainer way, each rule, cutoff and stratum
by itself under Holm's correction; it needs many more labels.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airq.llm.tables import kept_table

SPACES = "[\\x20\\x09-\\x0D]+"
VISIBLE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
SPAN = 8
RISK, LEVEL = 0.03, 0.05
#: First hexadecimal digits of the hashes of labelled documents (a quarter of them) that choose the rules' ends in ``joint_cutoffs``; the others test.
CHOOSING = ("0", "4", "8", "c")
#: Upper ends of the length strata, in words; one more stratum has no end.
BANDS = (64, 256, 1024)
#: Rule -> (numerator, denominator, cutoffs); a document is rejected when the ratio is above the cutoff.
RULES = {
    "symbols": ("n_symbols", "n_words", (0.05, 0.1, 0.2, 0.4, 0.8, 1.6)),
    "marks": ("n_marks", "n_words", (0.05, 0.1, 0.2, 0.4, 0.6, 0.8)),
    "lines": ("n_dup_lines", "n_lines", (0.1, 0.2, 0.3, 0.4, 0.6, 0.8)),
    "repeats": ("n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.25)),
    "again": ("n_words - n_distinct", "n_words", (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)),
    "long": ("word_chars", "n_words", (8.0, 10.0, 12.0, 16.0, 24.0, 48.0)),
}
RATIO = {r: f"coalesce(cast({a} as double) / nullif({b}, 0), 0)" for r, (a, b, _) in RULES.items()}


def _without(text: Column, chars: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole text; NULL and empty texts have none of anything.

    Windows of SPAN words are compared by 64-bit hashes. Only where one occurs twice are they
    sorted with their places; the words covered are then summed over gaps between places.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(
        "doc_id",
        "text",
        F.filter(F.split("text", SPACES, -1), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(VISIBLE)).alias("lines"),
    )
    d = d.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.octet_length("text") - F.octet_length(_without(F.col("text"), "!"))).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    last = F.size("hashes") - (SPAN - 1)
    d = d.withColumns({
        "n_distinct": F.size(F.array_distinct("hashes")).cast("long"),
        "windows": F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice("hashes", i, SPAN)))),
    }).drop("hashes")
    d = d.withColumn("twice", F.size(F.array_distinct("windows")) < F.size("windows"))
    d = d.withColumn("placed", F.when(F.col("twice"), F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows", "twice")

    def same(x, k):
        return F.get("placed", k)["h"].eqNullSafe(x["h"])

    d = d.withColumn("places", F.sort_array(F.transform(F.filter("placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))).drop("placed")
    steps = F.transform("places", lambda p, k: F.coalesce(F.least(F.get("places", k + 1) - p, F.lit(SPAN)), F.lit(SPAN)))
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop("places")


def scored(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, stratum and the rules' ratios."""
    d = counts(docs).withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    stratum = reduce(lambda c, k: F.when(F.col("n_words") <= BANDS[k], k).otherwise(c), reversed(range(len(BANDS))), F.lit(len(BANDS)))
    return d.withColumns({"stratum": stratum} | {f"r_{r}": F.expr(x) for r, x in RATIO.items()})


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for n trials of chance p, summed term by term; 1 where k is at least the expected count, where nothing could be proven."""
    first = n * F.log(F.lit(1 - p))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i * (p / (1 - p)))
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    terms = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)))).otherwise(F.array().cast("array<bigint>")), F.struct(first.alias("term"), F.exp(first).alias("sum")), step, lambda acc: acc["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(terms)


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Proven cutoffs: one row per stratum with a column ``c_<rule>`` each (NULL: none).

    ``rows`` as from ``scored``; a document counts as good when its label (the lowest, if it has
    several) is 1 and it passes the base rules. Counts take one aggregate over all labelled
    documents; what follows has one row per rule, cutoff and stratum.
    """
    good = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").alias("_quality")).filter("_quality = 1")
    held = rows.filter("NOT base_failed").join(good, F.col("doc_id") == F.col("_labelled"))
    share = risk / len(RULES)
    tests = [(r, j, c) for r, (_, _, grid) in RULES.items() for j, c in enumerate(grid)]
    n_tests = len(tests) * (len(BANDS) + 1)
    wide = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.sum((F.col(f"r_{r}") > c).cast("long")).alias(f"{r}_{j}") for r, j, c in tests])
    tall = wide.select("stratum", "n", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{r}_{j}").alias("k")) for r, j, c in tests])).alias("t")).select("stratum", "n", "t.*")
    order = Window.orderBy("p", "rule", "cutoff", "stratum")
    tall = tall.withColumn("p", binomial_cdf(F.col("k"), F.col("n"), share)).withColumn("i", F.row_number().over(order))
    tall = tall.withColumn("proven", F.min(F.col("p") <= level / (n_tests - F.col("i") + 1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return tall.filter("proven").groupBy(F.col("stratum").alias("_stratum")).agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in RULES])


def joint_cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Cutoffs proven together, from laxest to strictest: columns and rows as from ``cutoffs``.

    The labelled good documents of a stratum are dealt in two parts by a hash of their id. Of the
    smaller one (a quarter) each rule takes its end: the strictest cutoff that rejects at most the rule's
    share of ``risk``. The other part tests a fixed order of steps, the laxest cutoff of every rule first,
    each rule up to its end: a step is proven if all rules so far together reject less than
    ``risk``, by an exact binomial test at ``level`` over the number of strata, and the order
    stops at the first that isn't. So with probability 1 - ``level`` every stratum loses at most
    ``risk`` of its good documents. Without a false rejection ``labels_needed`` documents must test.
    """
    good = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").alias("_quality")).filter("_quality = 1")
    held = rows.filter("NOT base_failed").join(good, F.col("doc_id") == F.col("_labelled"))
    tests = steps()
    over = [(F.col(f"r_{r}") > c).cast("int") for _, r, c in tests]
    choosing = F.substring(F.md5(F.concat(F.lit("choosing "), F.col("_labelled").cast("string"))), 1, 1).isin(*CHOOSING)
    few = held.filter(choosing).groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"k_{i}") for i, x in enumerate(over)])
    used = few.select(F.col("stratum").alias("_chosen"), *[(F.col(f"k_{i}") <= F.col("n") * (risk / len(RULES))).alias(f"u_{i}") for i in range(len(tests))])
    tested = held.filter(~choosing).join(F.broadcast(used), F.col("stratum") == F.col("_chosen"))
    at = F.least(*[F.when(F.col(f"u_{i}") & (x > 0), i).otherwise(len(tests)) for i, x in enumerate(over)])  # the step that rejects the document first
    wide = tested.withColumn("_at", at).groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(f"u_{i}").alias(f"u_{i}") for i in range(len(tests))], *[F.sum((F.col("_at") <= i).cast("long")).alias(f"k_{i}") for i in range(len(tests))]
    )
    tall = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"u_{i}").alias("used"), F.col(f"k_{i}").alias("k")) for i, r, c in tests])
    tall = wide.select("stratum", "n", F.explode(tall).alias("t")).select("stratum", "n", "t.*")
    proven = F.min(binomial_cdf(F.col("k"), F.col("n"), risk) <= level / (len(BANDS) + 1)).over(Window.partitionBy("stratum").orderBy("i"))
    tall = tall.withColumn("proven", proven).filter("proven AND used")
    return tall.groupBy(F.col("stratum").alias("_stratum")).agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in RULES])


def labels_needed(risk: float = RISK, level: float = LEVEL) -> int:
    """Good documents that must test a stratum before ``joint_cutoffs`` can prove anything there."""
    return ceil(log(level / (len(BANDS) + 1)) / log(1 - risk))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, prove=joint_cutoffs) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    A document fails the base rules with fewer than 20 words (so NULL and empty texts fail) or
    with over 30 % of its words in repeated windows; else the proven cutoffs of its stratum
    decide. Without labels nothing is proven and only the base rules reject. Rows that share a
    ``doc_id`` are judged each by its own text. ``prove`` is ``joint_cutoffs`` (as the SQL twin does) or ``cutoffs``.
    """
    rows = kept_table(scored(docs), "quality-counts")
    cut = prove(rows, labels, risk, level)
    passed = reduce(lambda a, r: a & F.coalesce(F.col(f"r_{r}") <= F.col(f"c_{r}"), F.lit(True)), RULES, ~F.col("base_failed"))
    out = rows.join(F.broadcast(cut), F.col("stratum") == F.col("_stratum"), "left")  # at most one row per stratum
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", passed.alias("kept"))


def steps() -> list[tuple[int, str, float]]:
    """(place, rule, cutoff) in the order in which ``joint_cutoffs`` tests: the laxest cutoff of every rule first."""
    width = max(len(g) for _, _, g in RULES.values())
    order = [(r, g[j]) for j in reversed(range(width)) for r, (_, _, g) in RULES.items() if j < len(g)]
    return [(i, r, c) for i, (r, c) in enumerate(order)]


def oracle(risk: float = RISK, level: float = LEVEL) -> str:
    share = risk / len(RULES)
    grid = ", ".join(f"({i}, '{r}', {c!r}::DOUBLE)" for i, r, c in steps())
    digits = ", ".join(f"'{d}'" for d in CHOOSING)
    ratios = ", ".join(f"{x} AS r_{r}" for r, x in RATIO.items())
    value = "CASE rule " + " ".join(f"WHEN '{r}' THEN r_{r}" for r in RULES) + " END"
    band = "CASE " + " ".join(f"WHEN n_words <= {b} THEN {k}" for k, b in enumerate(BANDS)) + f" ELSE {len(BANDS)} END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
w AS (SELECT doc_id, unnest(list_transform(range(1, len(words) - {SPAN - 2}), lambda i: {{'i': i, 's': array_to_string(words[i:i + {SPAN - 1}], ' ')}})) AS x FROM a WHERE len(words) >= {SPAN}),
v AS (SELECT doc_id, x.i AS i, count(*) OVER (PARTITION BY doc_id, x.s) AS n FROM w),
g AS (SELECT doc_id, least({SPAN}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {SPAN})) AS step FROM v WHERE n > 1),
m AS (SELECT doc_id, sum(step)::BIGINT AS n_repeat_words FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols, (length(text) - length(replace(text, '!', '')))::BIGINT AS n_marks,
  len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(list_distinct(words))::BIGINT AS n_distinct,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM a LEFT JOIN m USING (doc_id)),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {band} AS stratum, {ratios} FROM c),
q AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
grid AS (SELECT * FROM (VALUES {grid}) AS x(i, rule, cutoff)),
z AS (SELECT s.*, row_number() OVER () AS row, substr(md5('choosing ' || CAST(doc_id AS VARCHAR)), 1, 1) IN ({digits}) AS choosing FROM s JOIN q USING (doc_id) WHERE NOT base_failed),
u AS (SELECT stratum, i FROM z, grid WHERE choosing GROUP BY ALL HAVING count(*) FILTER ({value} > cutoff) <= count(*) * {share!r}),
f AS (SELECT z.stratum, row, min(CASE WHEN {value} > cutoff AND u.i IS NOT NULL THEN grid.i END) AS first_step
  FROM z CROSS JOIN grid LEFT JOIN u ON u.stratum = z.stratum AND u.i = grid.i WHERE NOT choosing AND z.stratum IN (SELECT stratum FROM z WHERE choosing) GROUP BY ALL),
k AS (SELECT stratum, i, rule, cutoff, count(*) AS n, count(*) FILTER (first_step <= i) AS k FROM f, grid GROUP BY ALL),
p AS (SELECT *, CASE WHEN k >= n * {risk!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
  exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r})))) END AS p FROM k),
h AS (SELECT *, bool_and(p <= {level!r} / {len(BANDS) + 1}) OVER (PARTITION BY stratum ORDER BY i ROWS UNBOUNDED PRECEDING) AS proven FROM p),
b AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM h SEMI JOIN u USING (stratum, i) WHERE proven GROUP BY ALL),
r AS (SELECT DISTINCT doc_id FROM s JOIN b USING (stratum) WHERE {value} > cutoff)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND r.doc_id IS NULL AS kept FROM s LEFT JOIN r USING (doc_id)
"""
