"""URL filter: rules first, then a ratio of two character language models, in SQL only.

Rules name a host (with its subdomains) and the start of a path; the longest that
fits decides. The urls that rules judge also train two smoothed variable-order
Markov models, one of allowed and one of blocked urls: for each character the
estimates after 3, 2, 1 and 0 preceding characters are interpolated by
Witten-Bell weights. A url's score is the mean log-likelihood difference per
character. The cut is calibrated on the judged urls: half-way between the mean
scores of the two classes. If either class is empty nothing can be learned, and
urls without a rule are allowed.

Counts are summed per four-character window before anything is shuffled, tables
of shorter contexts derive from that one, and distinct urls are scored once.
Null urls and urls without ``://`` have an empty host and path and no rule; a null
url has no score and is allowed. Repeated rows stay. Only the key and the url
are read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.sources.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\\u0002", "\\u0003"


class Rule(NamedTuple):
    """Verdict for a host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def fits(self) -> str:
        return f"((host = '{self.host}' OR endswith(host, '.{self.host}')) AND startswith(path, '{self.path}'))"


# The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def parse(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``url``, ``host`` and ``path`` of every row."""
    rest = "substr(url, instr(url, '://') + 3)"
    known = "url IS NOT NULL AND instr(url, '://') > 0"
    return pages.select(F.col(key).alias("key"), F.col(url).alias("url")).selectExpr(
        "key",
        "url",
        f"CASE WHEN {known} THEN translate(regexp_extract({rest}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') ELSE '' END AS host",
        f"CASE WHEN {known} THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path",
    )


def apply_rules(parsed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``ruled`` (its verdict), both null where none fits."""
    longest = sorted(rules, key=lambda r: (-len(r.name), r.name))
    cases = lambda what: "CASE " + " ".join(f"WHEN {r.fits} THEN '{what(r)}'" for r in longest) + " END"
    if not rules:
        return parsed.selectExpr("*", "CAST(NULL AS STRING) AS rule", "CAST(NULL AS STRING) AS ruled")
    return parsed.selectExpr("*", f"{cases(lambda r: r.name)} AS rule", f"{cases(lambda r: r.verdict)} AS ruled")


def _windows(urls: DataFrame) -> DataFrame:
    """Every character of every distinct url with the three before it, as ``gram``."""
    padded = urls.selectExpr(
        "id", "size_", "ruled", f"concat('{START}{START}{START}', translate(url, '{UPPER}', '{LOWER}'), '{END}') AS padded"
    )
    return padded.selectExpr("id", "size_", "ruled", "explode(sequence(1, length(padded) - 3)) AS at", "padded").selectExpr(
        "id", "size_", "ruled", "substr(padded, at, 4) AS gram"
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that it is worked out once."""
    path = scratch_path(df.sparkSession, f"urls-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def log_ratios(windows: DataFrame) -> DataFrame:
    """``gram`` and ``delta``: log-probability of its last character as allowed less as blocked."""
    counts = windows.groupBy("gram").agg(
        F.expr("count_if(ruled = 'allow')").alias("allow"), F.expr("count_if(ruled = 'block')").alias("block")
    )
    levels = [_stored(counts, "counts")]
    for _ in range(3):
        levels.append(
            levels[-1].groupBy(F.expr("substr(gram, 2)").alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        )
    levels.reverse()
    size = levels[0].agg(F.count("*").alias("alphabet"))
    below = None
    for order, level in enumerate(levels):
        stats = level.groupBy(F.expr(f"substr(gram, 1, {order})").alias("context")).agg(
            *[F.sum(c).alias(f"all_{c}") for c in ("allow", "block")],
            *[F.expr(f"count_if({c} > 0)").alias(f"kinds_{c}") for c in ("allow", "block")],
        )
        joined = level.join(stats, F.expr(f"substr(gram, 1, {order}) = context"))
        if below is None:
            # One row: how many characters there are.
            joined = joined.join(F.broadcast(size)).selectExpr("*", "1D / alphabet AS low_allow", "1D / alphabet AS low_block")
        else:
            joined = joined.join(
                below.selectExpr("gram AS shorter", "p_allow AS low_allow", "p_block AS low_block"), F.expr("substr(gram, 2) = shorter")
            )
        below = joined.selectExpr(
            "gram",
            *[
                f"CASE WHEN all_{c} = 0 THEN low_{c} ELSE ({c} + kinds_{c} * low_{c}) / (all_{c} + kinds_{c}) END AS p_{c}"
                for c in ("allow", "block")
            ],
        )
    return below.selectExpr("gram", "ln(p_allow) - ln(p_block) AS delta")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: ``key``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (null without a model)."""
    judged = apply_rules(parse(pages, key, url), rules)
    # Rows are found again by two hashes of the url, which are shuffled in its place.
    marked = judged.selectExpr("*", "xxhash64(url) AS id", "crc32(CAST(url AS BINARY)) AS size_")
    distinct = marked.where("url IS NOT NULL").groupBy("id", "size_").agg(F.first("url").alias("url"), F.first("ruled").alias("ruled"))
    windows = _windows(_stored(distinct, "distinct"))
    scores = windows.join(_stored(log_ratios(windows), "ratios"), "gram").groupBy("id", "size_")
    scores = _stored(scores.agg(F.avg("delta").alias("score"), F.first("ruled").alias("ruled")), "scores")
    means = scores.agg(
        F.expr("avg(score) FILTER (WHERE ruled = 'allow')").alias("a"), F.expr("avg(score) FILTER (WHERE ruled = 'block')").alias("b")
    ).first()
    if means.a is None or means.b is None:
        return judged.selectExpr(f"key AS `{key}`", "host", "path", "rule", "coalesce(ruled, 'allow') AS verdict", "CAST(NULL AS DOUBLE) AS score")
    cut = (means.a + means.b) / 2
    return marked.join(scores.drop("ruled"), ["id", "size_"], "left").selectExpr(
        f"key AS `{key}`", "host", "path", "rule",
        f"coalesce(ruled, CASE WHEN score < {cut!r}D THEN 'block' ELSE 'allow' END) AS verdict", "score",
    )
