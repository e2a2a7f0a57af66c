"""URL filters: a blocked Bloom filter of the listed keys lets possible hits through to an exact hash join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

#: Bits of the filter for each key, and of a block: a key sets one bit in each of the 8 words of its block.
BITS_PER_KEY, BLOCK_BITS, WORDS = 16, 256, 8
#: Bytes of a filter that are sent to workers at once. A larger filter is cut into shards of so many, by ranges of its blocks.
SHARD_BYTES = 64 << 20
#: Query parameters that say where a visitor came from, not what the page is.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref", "fbclid", "gclid")

_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)  # fixed values of the public Parquet split-block filter


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without default port, path without trailing slashes, and the parameters that are not tracking, sorted. The scheme and fragment don't matter."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    names = "|".join(TRACKING)
    kept = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(rf"^({names})(=|$)")))
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.coalesce(F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")), F.lit(""))


# --- the filter --------------------------------------------------------------------------------------------------------


def _places(hashes: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its bit in each of the block's words."""
    h = hashes.view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)
    bits = (h.astype(np.uint32)[:, None] * _SALTS[None, :]) >> np.uint32(27)
    return block.astype(np.int64), bits


def blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // BLOCK_BITS))


def build_filter(keys: DataFrame, hashed: str, n_blocks: int, first: int = 0, stop: int | None = None) -> np.ndarray:
    """Blocks ``first`` to ``stop`` of the filter of the keys' hashes, 8 words each. Workers set bits, rows of the same block are combined, the driver gets the blocks."""
    masks = [f"m{i}" for i in range(WORDS)]

    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block, places = _places(batch["h"].to_numpy(), n_blocks)
            yield pd.DataFrame({"block": block - first} | {m: (np.int64(1) << places[:, i].astype(np.int64)) for i, m in enumerate(masks)})

    rows = keys.select(F.col(hashed).alias("h")).mapInPandas(bits, "block long, " + ", ".join(f"{m} long" for m in masks))
    found = rows.groupBy("block").agg(*[F.bit_or(m).alias(m) for m in masks]).toArrow()  # as many rows as blocks at most
    out = np.zeros(((stop or n_blocks) - first, WORDS), np.uint32)
    if found.num_rows:
        out[found.column("block").to_numpy()] = np.column_stack([found.column(m).to_numpy() for m in masks]).astype(np.uint32)
    return out


def might_contain(bloom: np.ndarray, hashes: np.ndarray, n_blocks: int | None = None, first: int = 0) -> np.ndarray:
    """Whether a filter of ``n_blocks`` may hold the hashes, which all belong to the blocks given, from number ``first`` on."""
    block, bits = _places(hashes, n_blocks or len(bloom))
    return ((bloom[block - first] >> bits) & np.uint32(1)).all(1)


def _block_of(hashed: Column, n_blocks: int) -> Column:
    return F.shiftrightunsigned(F.shiftrightunsigned(hashed, 32) * n_blocks, 32)


def _probe(sent: Broadcast, n_blocks: int, first: int) -> Callable:
    @F.pandas_udf("boolean")
    def probe(h: pd.Series) -> pd.Series:
        return pd.Series(might_contain(sent.value, h.to_numpy(), n_blocks, first))

    return probe


def _possible(probes: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The rows of ``probes`` whose hash ``h`` the filter of the keys' hashes may hold.

    Every shard of the filter is built from the keys of its blocks and tested with the probes of its blocks. There is one unless the keys are very many.
    """
    spark = probes.sparkSession
    n_blocks = blocks_for(n_keys)
    size = max(1, SHARD_BYTES * 8 // BLOCK_BITS)
    out = None
    for first in range(0, n_blocks, size):
        stop = min(first + size, n_blocks)
        within = _block_of(F.col("h"), n_blocks).between(first, stop - 1) if stop - first < n_blocks else F.lit(True)
        sent = spark.sparkContext.broadcast(build_filter(keys.where(within), "h", n_blocks, first, stop))
        own = probes.where(within).where(_probe(sent, n_blocks, first)("h"))
        out = own if out is None else out.unionByName(own)
    return out


# --- the operator ------------------------------------------------------------------------------------------------------


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every ``host suffix + path prefix`` that a rule could name: the host's suffixes at dots, the path's prefixes of the lengths that rules have."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length(path) >= n, path.substr(1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    prefixes = F.filter(prefixes, lambda p: p.isNotNull())
    return F.when(host != "", F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r:"), s, p))))).otherwise(F.array().cast("array<string>"))


def judge(urls: DataFrame, url: str, rules: list[Rule], listed: DataFrame | None = None, listed_url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``url, host, path, rule, verdict``, one row for each distinct url of ``urls``, null included.

    A rule fits its host and all subdomains where the path starts with the rule's; of several the longest wins, and of equally long ones that
    with the longer host. Its verdict stands. A URL that no rule fits is blocked if its canonical form is that of a listed URL, else
    it gets ``otherwise``; ``rule`` is null for both. A null URL or one without ``://`` has empty host and path and is not looked up in the list. Of
    repeated rules the last holds. Null and repeated listed URLs are allowed; empty tables give what they imply.

    Rules and listed URLs are keys of one Bloom filter. Each URL is tested for its own canonical form and for the few suffixes
    and prefixes of its host and path that a rule could name; keys that the filter may hold are joined with the listed keys by hash, which
    removes false positives. Rules are held in the driver and broadcast; the list may be of any length: the filter is built and
    sent in shards of SHARD_BYTES.
    """
    spark = urls.sparkSession
    last = {rule.text: rule for rule in rules}
    rule_rows = spark.createDataFrame([("r:" + t, t, r.verdict, len(r.host)) for t, r in last.items()], "key string, rule string, verdict string, host_length int")
    lengths = sorted({len(r.path) for r in last.values()})
    distinct = urls.select(F.col(url).cast("string").alias("url")).distinct()
    parts = distinct.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical"))
    pages = cut(parts.select("url", "host", "path", F.when(F.col("canonical") != "", F.concat(F.lit("u:"), "canonical")).alias("own"), rule_keys(F.col("host"), F.col("path"), lengths).alias("keys")))
    names = spark.createDataFrame([], "key string")
    if listed is not None:
        names = listed.select(canonical(F.col(listed_url).cast("string")).alias("c")).where("c != ''").select(F.concat(F.lit("u:"), "c").alias("key")).distinct()
    names = cut(names)
    hashed = F.xxhash64("key").alias("h")
    known = names.select(hashed).unionByName(rule_rows.select(hashed))
    probed = F.concat(F.when(F.col("own").isNotNull(), F.array("own")).otherwise(F.array().cast("array<string>")), F.col("keys"))
    probes = pages.select("url", F.explode(probed).alias("key")).select("url", "key", hashed)
    tested = cut(_possible(probes, known, names.count() + len(last)).select("url", "key"))
    # a rule's key is common to many URLs, but rules are few; a listed key is shared by the spellings of one page only
    hits = tested.where(F.col("key").startswith("r:")).join(F.broadcast(rule_rows), "key")
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "host_length")).alias("best")
    ruled = hits.groupBy("url").agg(best).select("url", "best.rule", "best.verdict")
    blocked = tested.where(F.col("key").startswith("u:")).join(names, "key", "left_semi").select("url", F.lit(True).alias("is_listed"))
    out = pages.select("url", "host", "path").join(ruled, "url", "left").join(blocked, "url", "left")
    verdict = F.coalesce("verdict", F.when(F.col("is_listed"), F.lit("block")).otherwise(F.lit(otherwise)))
    return out.select("url", "host", "path", "rule", verdict.alias("verdict"))


def filter_pages(pages: DataFrame, rules: list[Rule], listed: DataFrame | None = None, url: str = "url", listed_url: str = "url", otherwise: str = "allow") -> DataFrame:
    """The rows of ``pages`` with all columns and ``url_host, url_path, url_rule, url_verdict``; repeated rows stay, null URLs are judged as empty ones.

    Columns that already have these four names are replaced.
    """
    judged = cut(judge(pages, url, rules, listed, listed_url, otherwise))
    own = ["host", "path", "rule", "verdict"]
    kept = pages.drop(*[f"url_{c}" for c in own])
    key = fresh(kept, "judged")
    named = judged.where("url IS NOT NULL").select(F.col("url").alias(key), *[F.col(c).alias(f"url_{c}") for c in own])
    out = kept.join(named, F.col(url).cast("string") == F.col(key), "left").drop(key)
    return out.withColumns({"url_host": F.coalesce("url_host", F.lit("")), "url_path": F.coalesce("url_path", F.lit("")), "url_verdict": F.coalesce("url_verdict", F.lit(otherwise))})
