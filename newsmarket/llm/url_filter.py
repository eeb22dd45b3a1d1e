"""URL filter: rules first, then the ratio of two character language models.

Two Markov models of variable order, one of accepted and one of rejected URLs (those that a rule
decides), give each character its probability after up to four characters, smoothed over shorter
histories. A URL's score is the mean log-likelihood difference per character; the threshold is
calibrated half-way between the mean scores of accepted and rejected URLs. All of it is DataFrame
operations: counts are partial aggregates of five-character windows, and everything after works on
distinct windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, read

#: Rule and verdict; a rule is a host, then the start of a path.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
ORDER = 5
#: Weight of the next shorter history, and the number of characters at the lowest level.
BACKOFF, ALPHABET = 2.0, 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed characters that a URL can't hold: before its start and after its end.
START, END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule(rules: dict[str, str]) -> Column:
    """The longest rule that fits a host and a path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the last test is made first
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _log_ratios(windows: DataFrame) -> DataFrame:
    """g, ratio: log-probability difference of each distinct window's last character.

    windows: g, accepted, rejected (counts). From order to order, a window's count is that of its
    last characters, its history's count is the sum over the windows that share the history, and
    the shorter window's probability is joined in. All rows are distinct strings.
    """
    lower = None
    for k in range(1, ORDER + 1):
        t = windows.groupBy(F.expr(f"right(g, {k})").alias("g")).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        history = Window.partitionBy(F.expr(f"left(g, {k - 1})"))
        for side in ("accepted", "rejected"):
            t = t.withColumn(f"{side}_n", F.sum(side).over(history))
        if lower is None:
            t = t.withColumn("p_accepted", F.lit(1.0 / ALPHABET)).withColumn("p_rejected", F.lit(1.0 / ALPHABET))
        else:
            t = t.withColumn("shorter", F.expr(f"right(g, {k - 1})")).join(lower, "shorter")
        p = [((F.col(s) + BACKOFF * F.col(f"p_{s}")) / (F.col(f"{s}_n") + BACKOFF)).alias(f"p_{s}") for s in ("accepted", "rejected")]
        t = t.select("g", *p)
        lower = t.withColumnRenamed("g", "shorter")
    return t.select("g", (F.ln("p_accepted") - F.ln("p_rejected")).alias("ratio"))


def judge(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for each row of pages.

    A null url, or one without ``://``, has an empty host and path. Where no rule fits, the
    verdict is allow if the score reaches the calibrated threshold; without accepted or rejected
    URLs to learn from all scores are equal or the threshold is 0. Repeated rows are judged alike.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path")).withColumn("rule", _rule(rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, verdict).otherwise(ruled)
    base = base.withColumn("ruled", ruled)
    urls = base.groupBy("host", "path", "ruled").agg(F.count("*").alias("n"))
    padded = F.concat(F.lit(START * (ORDER - 1)), "host", "path", F.lit(END))
    cut = F.transform(F.sequence(F.lit(1), F.length("host") + F.length("path") + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))
    # Distinct URLs are few beside what they explode to, so they are dealt to all tasks first.
    cuts = urls.repartition(partitions(pages.sparkSession), "host", "path").withColumn("g", F.explode(cut))
    windows = cuts.groupBy("g").agg(*[F.sum(F.when(F.col("ruled") == v, F.col("n")).otherwise(0)).alias(c) for v, c in (("allow", "accepted"), ("block", "rejected"))])
    scored = cuts.join(_log_ratios(windows), "g").groupBy("host", "path", "ruled", "n").agg(F.avg("ratio").alias("score"))
    means = scored.agg(*[(F.sum(F.when(F.col("ruled") == v, F.col("score") * F.col("n"))) / F.sum(F.when(F.col("ruled") == v, F.col("n")))).alias(v) for v in ("allow", "block")])
    threshold = means.select(F.coalesce((F.col("allow") + F.col("block")) / 2, F.lit(0.0)).alias("threshold"))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block"))
    out = base.join(scored.select("host", "path", "score"), ["host", "path"]).join(F.broadcast(threshold))  # one row
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 6).alias("score"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


def _sql() -> str:
    fits = lambda r: f"(host = '{r.split('/')[0]}' OR host LIKE '%.{r.split('/')[0]}') AND starts_with(path, '/{r.split('/', 1)[1]}')"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r in sorted(RULES, key=lambda r: (-len(r), r)))
    ruled = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES.items())
    out = f"""WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
base AS (SELECT *, CASE rule {ruled} END AS ruled FROM (SELECT *, CASE {rule} END AS rule FROM parts)),
urls AS (SELECT host, path, ruled, count(*) AS n FROM base GROUP BY ALL),
cuts AS (SELECT host, path, ruled, n, substr(repeat(chr(2), {ORDER - 1}) || host || path || chr(3), i, {ORDER}) AS g FROM urls, unnest(range(1, length(host) + length(path) + 2)) AS u(i)),
w AS (SELECT g, sum(CASE WHEN ruled = 'allow' THEN n ELSE 0 END) AS a, sum(CASE WHEN ruled = 'block' THEN n ELSE 0 END) AS r FROM cuts GROUP BY g),
"""
    for k in range(1, ORDER + 1):
        sums = f"SELECT right(g, {k}) AS g, sum(a) AS a, sum(r) AS r FROM w GROUP BY 1"
        low = f"1.0 / {ALPHABET}" if k == 1 else "l.pa", f"1.0 / {ALPHABET}" if k == 1 else "l.pr"
        join = "" if k == 1 else f" JOIN p{k - 1} l ON l.g = right(c.g, {k - 1})"
        out += f"p{k} AS (SELECT c.g, (a + {BACKOFF} * {low[0]}::DOUBLE) / (an + {BACKOFF}) AS pa, (r + {BACKOFF} * {low[1]}::DOUBLE) / (rn + {BACKOFF}) AS pr FROM (SELECT *, sum(a) OVER h AS an, sum(r) OVER h AS rn FROM ({sums}) WINDOW h AS (PARTITION BY left(g, {k - 1}))) c{join}),\n"
    return out + f"""scored AS (SELECT host, path, ruled, n, avg(ln(pa) - ln(pr)) AS score FROM cuts JOIN p{ORDER} p ON p.g = cuts.g GROUP BY host, path, ruled, n),
t AS (SELECT coalesce((sum(CASE WHEN ruled = 'allow' THEN score * n END) / sum(CASE WHEN ruled = 'allow' THEN n END) + sum(CASE WHEN ruled = 'block' THEN score * n END) / sum(CASE WHEN ruled = 'block' THEN n END)) / 2, 0) AS threshold FROM scored)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) AS score
FROM base JOIN (SELECT host, path, score FROM scored) USING (host, path), t"""


SQL = _sql()
