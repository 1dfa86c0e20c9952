"""Host-level quality rules, in DataFrame functions only.

Each document is measured by its own rules; the rules' failures are
aggregated per host, each host's rate is shrunk towards an empirical beta
prior fitted to all hosts, and a host whose shrunk rate is too high loses all
its documents.

Defined cases: a null or empty text has no words and fails; null hosts are
one host; rows may repeat and carry any other columns; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import join_measured, read, spare_name, stored, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host goes when its shrunk failure rate exceeds this.
MAX_HOST_RATE = 0.8
# Bounds of the prior's strength (alpha + beta), in documents.
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def _repeat_words(df: DataFrame, ws: str, out: str) -> DataFrame:
    """Add the number of words in 3-word windows that occur twice or more in
    the text. Windows are compared by a 64-bit hash within one text; only
    texts that repeat a window sort their windows."""
    hashes, pairs, starts = (spare_name(df, x) for x in ("__windows", "__sorted", "__starts"))
    n = F.size(ws)
    df = df.withColumn(hashes, F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn(pairs, F.when(repeats, F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda p, k: F.coalesce(F.get(pairs, k)["h"] == p["h"], F.lit(False))
    df = df.withColumn(starts, F.array_sort(F.transform(
        F.filter(pairs, lambda p, k: same(p, k - 1) | same(p, k + 1)), lambda p: p["i"])))
    covered = F.aggregate(
        F.transform(starts, lambda s, k: F.least(F.lit(3), F.get(starts, k + 1) - s)),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return df.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop(hashes, pairs, starts)


def measure(df: DataFrame, text: str = "text", only_rules: bool = False) -> DataFrame:
    """Add n_words, n_repeat_words, base_failed and, unless ``only_rules``,
    word_chars, n_symbols and n_dup_lines. Columns of these names are
    replaced."""
    ws = spare_name(df, "__words")
    body = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(ws, words(F.col(text)))
    out = _repeat_words(out, ws, "n_repeat_words")
    out = out.withColumn("n_words", F.size(ws).cast("long"))
    if not only_rules:
        rows = spare_name(out, "__lines")
        lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        out = (out.withColumn("word_chars", F.length(F.array_join(ws, "")).cast("long"))
                  .withColumn("n_symbols", (F.length(body) - F.length(
                      F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long"))
                  .withColumn(rows, lines)
                  .withColumn("n_dup_lines", (F.size(rows) - F.size(F.array_distinct(rows))).cast("long"))
                  .drop(rows))
    return out.withColumn("base_failed", base_failed()).drop(ws)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(measured: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: host, n_docs, n_failed, rate (shrunk), host_kept.

    The beta prior has the mean m and the variance v of the hosts' raw
    rates, so its strength is m(1-m)/v - 1, held within bounds. Counting is
    pre-aggregated, so a host with a third of all rows is no hot key."""
    hosts = stored(measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    raw = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"))
    fit = (F.least(F.greatest(F.col("m") * (1 - F.col("m")) / F.nullif(F.col("v"), F.lit(0.0)) - 1,
                              F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH)))
    fit = F.when(F.col("v") > 0, fit).otherwise(F.lit(MAX_STRENGTH))
    prior = prior.select(F.struct("m", fit.alias("k")).alias("p")).scalar()
    m, k = prior.getField("m"), prior.getField("k")
    rate = (F.col("n_failed") + m * k) / (F.col("n_docs") + k)
    return hosts.select("*", rate.alias("rate"), (rate <= MAX_HOST_RATE).alias("host_kept"))


def judge(measured: DataFrame, host: str = "source") -> DataFrame:
    """A stored table of measures with ``kept``: the document's own rules hold
    and its host is kept. (Stored, because a later filter on the verdict would
    otherwise be pushed into the measuring, once for each use of a step.)"""
    key, ok = spare_name(measured, "__host"), spare_name(measured, "__host_kept")
    hosts = host_verdicts(measured, host).select(F.col("host").alias(key), F.col("host_kept").alias(ok))
    joined = measured.join(hosts, measured[host].eqNullSafe(hosts[key]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col(ok), F.lit(True))).drop(key, ok)


def keep_good(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``df`` (same columns) that their own rules and their host
    keep. Texts are measured once; the verdicts come back by doc_id and a
    hash of text and host, which equal rows share."""
    col = lambda c: F.col(f"`{c}`")
    key = [F.coalesce(col(doc_id).cast("string"), F.lit("null")).alias("id"),
           F.xxhash64(F.coalesce(col(text), F.lit("")), F.coalesce(F.concat(F.lit("s"), col(host)), F.lit("n"))).alias("th")]
    body = df.select(*key, col(text).alias("text"), col(host).alias("source"))
    measured = stored(measure(body, only_rules=True).select("id", "th", "source", "base_failed"))
    rejected = stored(judge(measured).where(~F.col("kept")).select("id", "th").distinct())
    rows = df.select(F.struct(*map(col, df.columns)).alias("row"), *key)
    return join_measured(rows, rejected, ["id", "th"], "left_anti", F.length("id") + 24).select("row.*")


def op6_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judge(stored(measure(docs).select(*columns, "source"))).select(*columns, "kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i+2], ' ') AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c >= 2),
cov AS (SELECT r, count(DISTINCT p) AS c FROM (SELECT r, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS c
       FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(ln.c, 0)::BIGINT AS n_dup_lines, coalesce(cov.c, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN ln ON ln.r = d.r LEFT JOIN cov ON cov.r = d.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY source),
p AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
k AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) ELSE 1000.0 END AS k FROM p),
hv AS (SELECT source, (f + m * k) / (n + k) <= 0.8 AS ok FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ok AS kept
FROM b JOIN hv ON b.source IS NOT DISTINCT FROM hv.source
"""
