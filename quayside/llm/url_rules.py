"""URL verdicts by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression plus the literal tokens every URL it fits must hold. Running all
rules on all URLs costs rules times URLs; here each rule is filed under the one of its tokens that
the fewest URLs hold, and a URL meets only the rules filed under its own tokens.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_BREAK = "[^a-z0-9]+"
# Rules beyond this many bytes of pattern text are joined by shuffle, not sent to every executor.
BROADCAST_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` is run on ``host || path``; ``name`` is what a verdict reports.

    ``tokens`` are lower-case letter-digit runs that must occur, whole, in a URL the rule fits. A
    rule without tokens cannot be indexed. ``listed`` rules go before the others, then the longer
    ``weight`` wins, then the smaller name.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    weight: int
    listed: bool = True


def host_path_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule on a host with all its subdomains and on the start of the path.

    Only tokens the rule holds whole are literal: the path's last one may go on in the URL.
    """
    closed = re.split(TOKEN_BREAK, host) + re.split(TOKEN_BREAK, path.lower())[:-1]
    return Rule(
        name=host + path,
        pattern=rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}",
        tokens=tuple(dict.fromkeys(t for t in closed if t)),
        verdict=verdict,
        weight=len(host + path),
    )


def path_word_rule(word: str, pattern: str, verdict: str = "block") -> Rule:
    """A rule on the path, run only where ``word`` is one of the URL's tokens."""
    return Rule(word, pattern, (word,), verdict, len(pattern), listed=False)


def host_word_rule(word: str, verdict: str = "block") -> Rule:
    """A rule on a host with ``word`` between its dots or hyphens."""
    return Rule(word, rf"^([^/]*[.-])?{word}([.:-]|/|$)", (word,), verdict, len(word), listed=False)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, pattern_rule``.

    ``rule`` is the listed rule that fits, ``pattern_rule`` the unlisted one that decided; both are
    null where ``default`` holds. Each distinct URL is judged once, so a URL that many pages share
    costs no more than one. A null URL or one without ``://`` has an empty host and path, fits no
    rule and gets ``default``; repeated rows each get their verdict; a null id stays null; other
    columns of ``pages`` are not read. An empty table gives no rows.
    """
    spark = pages.sparkSession
    if bare := [r.name for r in rules if not r.tokens]:
        raise ValueError(f"rules without a literal token: {bare}")
    rows = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
    urls = rows.select("_url").distinct().select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    tokens = urls.select(
        "_url", "host", "path",
        F.explode(F.array_distinct(F.split(F.lower(F.concat("host", "path")), TOKEN_BREAK))).alias("token"),
    ).where("token <> ''")

    # from an Arrow table, so that no Python worker has to read the rules
    shape = [("name", pa.string()), ("pattern", pa.string()), ("verdict", pa.string()), ("weight", pa.int32()), ("listed", pa.bool_()), ("tokens", pa.list_(pa.string()))]
    book = spark.createDataFrame(pa.Table.from_pylist([{**vars(r), "tokens": list(r.tokens)} for r in rules], pa.schema(shape)))
    small = sum(len(r.pattern) + sum(map(len, r.tokens)) for r in rules) <= BROADCAST_BYTES
    sent = F.broadcast if small else (lambda df: df)

    literals = book.select("name", "pattern", "verdict", F.explode("tokens").alias("token"))
    held = tokens.join(sent(literals.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = Window.partitionBy("name", "pattern", "verdict").orderBy(F.col("urls").asc_nulls_first(), "token")
    index = (
        literals.join(held, "token", "left")
        .withColumn("urls", F.coalesce("urls", F.lit(0)))
        .withColumn("rank", F.row_number().over(rarest))
        .where("rank = 1")
        .select("name", "pattern", "verdict", "token")
        .join(sent(book.drop("tokens")), ["name", "pattern", "verdict"])
    )
    best = F.struct(
        F.col("listed"), F.col("weight"),
        # the smaller name wins a tie, so names are compared the other way round
        F.transform(F.split("name", ""), lambda c: -F.ascii(c)).alias("order"),
        F.col("name"), F.col("verdict"),
    )
    judged = (
        tokens.join(sent(index), "token")
        .where(F.expr("concat(host, path) rlike pattern"))
        .groupBy("_url")
        .agg(F.max(best).alias("best"))
    )
    verdicts = urls.join(judged, "_url", "left")
    return rows.join(verdicts, "_url").select(
        F.col("_id").alias(id_col), "host", "path",
        F.when(F.col("best.listed"), F.col("best.name")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
        F.when(~F.col("best.listed"), F.col("best.name")).alias("pattern_rule"),
    )


# Fixed values of the query's contract: host, path, verdict.
LISTED = [
    host_path_rule("org", "/", "allow"),
    host_path_rule("example.org", "/es/", "block"),
    host_path_rule("example.org", "/en/1", "block"),
    host_path_rule("com", "/fr/", "allow"),
    host_path_rule("com", "/de/", "block"),
]

# Hosts that name what they sell; paths that lead to no prose: forms, carts, feeds, machine ends.
UNLISTED = [host_word_rule(word) for word in ("adult", "porn", "xxx", "casino", "betting", "warez")]
UNLISTED += [
    path_word_rule(word, rf"/{word}(/|\.[a-z]+$|$)")
    for word in ("login", "signup", "logout", "cart", "checkout", "feed", "rss", "search", "admin", "ads", "banner", "tracker", "print", "api", "calendar")
]
