"""URL rules behind a blocked Bloom filter.

Only DataFrame functions run here. A rule is a host and a path prefix. Every
URL has a few candidate keys: its host and each parent domain, with each
prefix of its path whose length some rule has. A blocked Bloom filter over the
rules' keys (one 64-bit block a key, so one array access) passes possible
hits; these alone go on to an exact join with the rules, which removes false
positives. The longest rule that fits decides.

Defined cases: a null URL or one without ``://`` has an empty host and path
and fits no rule; an empty path fits only rules with an empty path; equal
lengths go to the longer host, then to ``block``; repeated rows each get their
own verdict; an empty rule table leaves every URL at ``default``; columns of
the input other than id and URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.llm.common import stage

# Blocks of 64 bits, as a power of two: four rules a block, within these bounds. From the
# upper one on (2 MB, a million rules) the filter passes more, and the exact join does the rest.
LEAST_BLOCK_BITS, MOST_BLOCK_BITS = 14, 18
RULES_A_BLOCK = 4
PROBES = 5
SEPARATOR = "\t"


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_ascii_lower(rest), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parse_rule(rule: str, verdict: str) -> tuple[str, str, str, str]:
    """``example.com/en/`` is the host example.com and the path ``/en/``."""
    host, slash, path = rule.partition("/")
    return rule, host.lower(), slash + path, verdict


def _block(key: Column, block_bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << block_bits)).cast("int")


def _mask(key: Column) -> Column:
    """PROBES bits of one 64-bit block."""
    h = F.xxhash64(key, F.lit(7))
    mask = F.lit(0).cast("bigint")
    for k in range(PROBES):
        bit = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def block_bits_for(n_rules: int) -> int:
    wanted = max(1, -(-n_rules // RULES_A_BLOCK) - 1).bit_length()
    return min(max(wanted, LEAST_BLOCK_BITS), MOST_BLOCK_BITS)


def bloom_blocks(keys: DataFrame, block_bits: int) -> dict[int, int]:
    """Blocks with a bit set. At most ``2**block_bits`` of them reach the driver."""
    rows = (
        keys.select(_block(F.col("key"), block_bits).alias("block"), _mask(F.col("key")).alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("mask"))
        .collect()
    )
    return {r["block"]: r["mask"] for r in rows}


def _might_contain(key: Column, blocks: dict[int, int], block_bits: int) -> Column:
    if not blocks:
        return F.lit(False)
    if len(blocks) < 100:
        # A lookup of the few blocks set takes less room than all of them.
        lists = F.create_map(*[F.lit(v) for pair in sorted(blocks.items()) for v in pair])
        word = F.try_element_at(lists, _block(key, block_bits))
    else:
        # One literal, which Spark folds to an array once, not one for each block.
        words = F.lit(" ".join(str(blocks.get(i, 0)) for i in range(1 << block_bits)))
        word = F.get(F.split(words, " ").cast("array<bigint>"), _block(key, block_bits))
    mask = _mask(key)
    return F.coalesce(word.bitwiseAND(mask) == mask, F.lit(False))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
    block_bits: int | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules``: ``rule, host, path, verdict``. The list may be long: it is joined
    by equality, and only the filter goes to every task. Its size follows the
    number of rules, up to a bound, unless ``block_bits`` says otherwise.
    """
    rules = rules.select("rule", "host", "path", "verdict").distinct()
    keyed = rules.withColumn("key", F.concat_ws(SEPARATOR, "host", "path"))
    if block_bits is None:
        block_bits = block_bits_for(keyed.count())
    blocks = bloom_blocks(keyed, block_bits)
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    url = F.col(url_column)
    parsed = pages.select(
        F.col(id_column).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path")
    )
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.array(
        *[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]
    )
    keys = F.flatten(
        F.transform(
            domains,
            lambda d: F.transform(
                F.filter(prefixes, lambda p: p.isNotNull()),
                lambda p: F.concat_ws(SEPARATOR, d, p),
            ),
        )
    )
    possible = F.filter(keys, lambda k: _might_contain(k, blocks, block_bits))
    if not lengths:
        possible = F.array().cast("array<string>")
    passed = parsed.withColumn("keys", possible)
    # A row with no possible hit is done. The others meet the rules by host and path,
    # once for each distinct pair, and the best is chosen before the join back.
    hit = F.col("page_id"), F.col("host"), F.col("path")
    candidates = (
        passed.select(F.col("keys"))
        .filter(F.size("keys") > 0)
        .groupBy("keys")
        .agg(F.count("*").alias("n"))
        .select("keys", F.explode("keys").alias("key"))
    )
    best = (
        candidates.join(keyed, "key")
        .groupBy("keys")
        .agg(
            F.max(
                F.struct(
                    (F.length("host") + F.length("path")).alias("size"),
                    F.length("host").alias("host_size"),
                    F.col("verdict").alias("verdict"),
                    F.col("rule").alias("rule"),
                )
            ).alias("best")
        )
    )
    # Written, so that Spark knows its size: small lists are broadcast, long ones are
    # joined with hot keys split.
    best = stage(pages.sparkSession, "urls").cut(best, "best")
    return passed.join(best, "keys", "left").select(
        *hit,
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
