"""URL filters: host rules, and pattern rules that are indexed by their rarest literal token.

Host rules name a host and a path prefix and hold for the host and its subdomains; the longest that fits decides.
All other URLs are judged by pattern rules. In a pattern, ``*`` stands for any characters, ``^`` for one that is
neither letter, digit, ``-``, ``_`` nor ``%``, or the end; anything else is literal. Upper and lower case
are the same.

The literal tokens of a pattern are its runs of letters and digits that a URL must hold as whole tokens: those
with a literal or ``^`` that is no letter or digit on both sides. Every rule is filed under the one of its tokens
that the fewest URLs have, and a URL fetches the rules filed under its own tokens. Only these run as regular
expressions. Rules without such a token are filed under the empty token, which every URL has.

Of the patterns that match a URL, an allowing one wins over blocking ones; a URL that none matches is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path, no host rule and, if null, no
tokens and the verdict of the empty URL; repeated ids and URLs are judged row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweir.llm.literals import literal_table
from tallyweir.session import broadcast_if_small, materialize

#: (host and path, verdict)
HOST_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]

#: (name, verdict, pattern)
PATTERN_RULES = [
    ("gambling", "block", "^casino-win."),
    ("betting", "block", "^free-bets."),
    ("pharmacy", "block", "^cheap-pills."),
    ("advertising", "block", "^ads-track."),
    ("adult", "block", "^adult-x."),
    ("spam", "block", "^spam-farm."),
    ("tracking-pixel", "block", "/pixel^*track"),
    ("ad-server", "block", "://ads."),
    ("login", "block", "/login^"),
    ("cart", "block", "/cart/*checkout^"),
    ("session-id", "block", "^phpsessid="),
    ("archive", "block", ".zip^"),
    ("help-pages", "allow", "/help/*login^"),
]


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str) -> tuple[Column, Column]:
    """The host after the first ``://`` in lower case, and the path up to the query or fragment."""
    rest = F.expr(f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def host_rule(host: str, path: str, rules: list[tuple[str, str]] | None = None) -> Column:
    """``struct(rule, verdict)`` of the longest host rule that fits, else null."""
    chosen = None
    for rule, verdict in sorted(rules or HOST_RULES, key=lambda r: (-len(r[0]), r[0])):
        name, prefix = rule.split("/", 1)
        fits = ((F.col(host) == name) | F.col(host).endswith(f".{name}")) & F.col(path).startswith(f"/{prefix}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen


def pattern_regex(pattern: str) -> Column:
    """The pattern as a regular expression."""
    escaped = F.regexp_replace(F.col(pattern), r"([\\.+?{}()\[\]|$])", r"\\$1")
    separated = F.regexp_replace(escaped, r"\^", r"(?:[^a-z0-9_%-]|\$)")
    return F.regexp_replace(separated, r"\*", ".*")


def rule_tokens(pattern: str) -> Column:
    """The literal tokens that every match holds as whole tokens, or the empty token if there are none."""
    tokens = F.expr(rf"regexp_extract_all({pattern}, '(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])', 0)")
    return F.when(F.size(tokens) > 0, F.array_distinct(tokens)).otherwise(F.array(F.lit("")))


def url_tokens(url: str) -> Column:
    """The distinct runs of letters and digits of a URL, and the empty token."""
    tokens = F.expr(f"regexp_extract_all({url}, '[a-z0-9]+', 0)")
    return F.array_distinct(F.concat(tokens, F.array(F.lit(""))))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Pattern rules as a table; rule lists of any size can be given as a DataFrame of the same columns instead."""
    return literal_table(spark, PATTERN_RULES if rules is None else rules, ["name", "verdict", "pattern"])


def index_rules(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with their ``regex`` and the ``token`` under which they are filed: the one in the fewest of ``urls`` (``_url``)."""
    lowered = rules.withColumn("pattern", lower_ascii(F.col("pattern")))
    literal = lowered.select("*", pattern_regex("pattern").alias("regex"), F.explode(rule_tokens("pattern")).alias("token"))
    literal = materialize(literal, "rule-tokens")
    wanted = broadcast_if_small(materialize(literal.select("token").distinct(), "wanted-tokens"))
    counts = (
        urls.select(F.explode(url_tokens("_url")).alias("token"))
        .join(wanted, "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    rated = literal.join(counts, "token", "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    rarest = rated.groupBy("name", "verdict", "pattern", "regex").agg(F.min(F.struct("uses", "token")).alias("filed"))
    return rarest.select("name", "verdict", "regex", F.col("filed.token").alias("token"))


def pattern_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``_url``, ``pattern_rule`` and ``pattern_verdict`` of the distinct ``urls`` (``_url``, lower case) that a rule matches."""
    index = materialize(index_rules(rules, urls), "rule-index")
    candidates = urls.select("_url", F.explode(url_tokens("_url")).alias("token")).join(
        broadcast_if_small(index), "token"
    )
    matching = candidates.filter("_url rlike regex")
    return matching.groupBy("_url").agg(
        F.min("verdict").alias("pattern_verdict"), F.min(F.struct("verdict", "name")).alias("_m")
    ).select("_url", "pattern_verdict", F.col("_m.name").alias("pattern_rule"))


def judge_pages(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``pattern_rule``.

    ``rule`` is the host rule that decided; ``pattern_rule`` names a pattern that matched where no host rule fits.
    """
    host, path = host_and_path("url")
    placed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    ruled = placed.withColumn("_h", host_rule("host", "path"))
    open_ = F.when(F.col("_h").isNull(), lower_ascii(F.coalesce("url", F.lit(""))))
    keyed = ruled.withColumn("_url", open_)
    urls = materialize(keyed.select("_url").filter("_url is not null").distinct(), "open-urls")
    found = pattern_verdicts(urls, rule_table(pages.sparkSession) if rules is None else rules)
    # few URLs match a rule as a rule; then the pages stay where they are, and so does a URL that many share
    judged = keyed.join(broadcast_if_small(materialize(found, "url-verdicts")), "_url", "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_h.rule").alias("rule"),
        F.coalesce("_h.verdict", "pattern_verdict", F.lit("allow")).alias("verdict"),
        "pattern_rule",
    )


#: DuckDB: the host rules as a table, the patterns as one expression each.
ORACLE_SQL = r"""
WITH rules(name, prefix, rule, verdict) AS (VALUES
  ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
  ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'),
  ('net', '/fr/', 'net/fr/', 'block')),
patterns(pattern_rule, verdict, regex) AS (VALUES
  ('gambling', 'block', '([^a-z0-9_%-]|$)casino-win\.'), ('betting', 'block', '([^a-z0-9_%-]|$)free-bets\.'),
  ('pharmacy', 'block', '([^a-z0-9_%-]|$)cheap-pills\.'), ('advertising', 'block', '([^a-z0-9_%-]|$)ads-track\.'),
  ('adult', 'block', '([^a-z0-9_%-]|$)adult-x\.'), ('spam', 'block', '([^a-z0-9_%-]|$)spam-farm\.'),
  ('tracking-pixel', 'block', '/pixel([^a-z0-9_%-]|$).*track'), ('ad-server', 'block', '://ads\.'),
  ('login', 'block', '/login([^a-z0-9_%-]|$)'), ('cart', 'block', '/cart/.*checkout([^a-z0-9_%-]|$)'),
  ('session-id', 'block', '([^a-z0-9_%-]|$)phpsessid='), ('archive', 'block', '\.zip([^a-z0-9_%-]|$)'),
  ('help-pages', 'allow', '/help/.*login([^a-z0-9_%-]|$)')),
parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
placed AS (
  SELECT page_id, url, lower(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM parts),
fitting AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM placed JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix)
  GROUP BY n),
matching AS (
  SELECT n, min(verdict) AS verdict, min(struct_pack(v := verdict, p := pattern_rule)).p AS pattern_rule
  FROM placed JOIN patterns ON regexp_matches(lower(coalesce(url, '')), regex)
  WHERE n NOT IN (SELECT n FROM fitting) GROUP BY n)
SELECT page_id, host, path, f.rule, coalesce(f.verdict, m.verdict, 'allow') AS verdict, m.pattern_rule
FROM placed LEFT JOIN fitting f USING (n) LEFT JOIN matching m USING (n)
"""
