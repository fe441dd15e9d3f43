"""URL rules held as a sorted array of 64-bit digests, memory-mapped by the tasks."""

from __future__ import annotations

import atexit
import json
import mmap
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a rule index that may be sent to every executor. A longer list is refused.
MAX_INDEX_BYTES = 1 << 30


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; '' if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}{path}".encode())


class DigestIndex:
    """A sorted array of the digests of all rules, with their full strings beside it.

    One file: a header with the array sizes and the shapes that rules take (how many host labels,
    how many characters of path), the sorted digests, string offsets, verdicts, then the strings.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(self._map[:8], "little")
        head = json.loads(self._map[8 : 8 + size])
        self.shapes = [tuple(x) for x in head["shapes"]]
        n, at = head["n"], -(-(8 + size) // 8) * 8
        self.keys = np.frombuffer(self._map, "<u8", n, at)
        self.ends = np.frombuffer(self._map, "<u8", n + 1, at + 8 * n)
        self.allow = np.frombuffer(self._map, "u1", n, at + 16 * n + 8)
        self._text = at + 17 * n + 8

    def rule(self, i: int) -> tuple[str, str]:
        """Host and path of rule i."""
        host, path = self._map[self._text + int(self.ends[i]) : self._text + int(self.ends[i + 1])].split(b"\0", 1)
        return host.decode(), path.decode()

    def find(self, pairs: list[tuple[str, str]]) -> np.ndarray:
        """Number of the rule that equals each (host, path), -1 if none: binary search, then comparison of strings."""
        digests = np.fromiter((_digest(*p) for p in pairs), "<u8", len(pairs))
        at = np.searchsorted(self.keys, digests)
        out = np.full(len(pairs), -1, "int64")
        if not len(self.keys):
            return out
        met = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests)
        for i in np.flatnonzero(met):
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == digests[i]:
                if self.rule(j) == pairs[i]:
                    out[i] = j
                    break
                j += 1
        return out


def write_index(rules: Iterable[tuple[str, str, str]], path: str) -> int:
    """Write the index of rules (verdict, host, path) and return its size in bytes.

    Hosts are lower-cased (A-Z). Of rules with the same host and path a block wins over an allow.
    """
    table: dict[tuple[str, str], bool] = {}
    for verdict, host, start in rules:
        if verdict not in ("allow", "block") or not host or "\0" in host:
            raise ValueError(f"not a rule: {verdict!r} {host!r} {start!r}")
        key = (host.translate(str.maketrans(UPPER, LOWER)), start)
        table[key] = table.get(key, True) and verdict == "allow"
    order = sorted(table, key=lambda k: (_digest(*k), k))
    strings = [f"{h}\0{p}".encode() for h, p in order]
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in order})
    head = json.dumps({"n": len(order), "shapes": shapes}).encode()
    with open(path, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        f.write(b"\0" * (-(8 + len(head)) % 8))
        f.write(np.array([_digest(*k) for k in order], "<u8").tobytes())
        f.write(np.cumsum([0, *map(len, strings)]).astype("<u8").tobytes())
        f.write(np.array([table[k] for k in order], "u1").tobytes())
        f.write(b"".join(strings) + b"\0")
    return os.path.getsize(path)


def candidates(host: str, path: str, shapes: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """What of a url could be a rule: its last n host labels with the first m characters of its path."""
    if not host:
        return []
    tails = {}
    for n in {n for n, _ in shapes}:
        parts = host.rsplit(".", n)
        if len(parts) == n + 1:
            tails[n] = host[len(parts[0]) + 1 :]
        elif len(parts) == n:
            tails[n] = host
    return [(tails[n], path[:m]) for n, m in shapes if n in tails and len(path) >= m]


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    max_index_bytes: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """Judge every url by the longest rule (verdict, host, path start) that fits it.

    A rule fits its host and all subdomains, if the url's path starts with the rule's path. The
    longest rule string wins, of equal ones that with the longer host; ``default`` holds where no
    rule fits. The rules go to each executor once, as a file of sorted digests whose size is
    checked; tasks map it and probe it, all urls of a batch at once. The pages are not shuffled.

    Returns page_id, host, path, rule (host and path, else null), verdict. A null url and one
    without :// have an empty host and path and get the default. Repeated rows are judged alike; an
    empty table gives an empty result, no rules the default for all. Other columns are not read.
    """
    handle, local = tempfile.mkstemp(prefix="url-rules-", suffix=".idx")
    os.close(handle)
    size = write_index(rules, local)
    if size > max_index_bytes:
        os.unlink(local)
        raise ValueError(f"the rule index has {size} bytes; max_index_bytes is {max_index_bytes}")
    pages.sparkSession.sparkContext.addFile(local)
    atexit.register(lambda: os.path.exists(local) and os.unlink(local))  # tasks get it from the driver as long as that lives
    name = os.path.basename(local)

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = DigestIndex(SparkFiles.get(name))
        for hosts, paths in parts:
            pairs, owners = [], []
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                own = candidates(host, path, index.shapes)
                pairs += own
                owners += [i] * len(own)
            best: dict[int, tuple] = {}
            for owner, pair, found in zip(owners, pairs, index.find(pairs), strict=True):
                if found >= 0:
                    rank = (len(pair[0]) + len(pair[1]), len(pair[0]), pair, "allow" if index.allow[found] else "block")
                    best[owner] = max(best.get(owner, rank), rank)
            yield pd.DataFrame(
                {
                    "rule": ["".join(best[i][2]) if i in best else None for i in range(len(hosts))],
                    "verdict": [best[i][3] if i in best else default for i in range(len(hosts))],
                },
                dtype=object,
            )

    found = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    return found.withColumn("found", judge("host", "path")).select("page_id", "host", "path", "found.rule", "found.verdict")
