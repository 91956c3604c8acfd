"""URL filters: the longest matching entry of an allow and block list.

Method: a trie over the host's labels from the last to the first and, below each host, over
the path's segments. The trie is as large as the list, whose size is checked, and is sent
to the executors once. A lookup walks the host's labels; at each node that an entry's host
ends at, it walks the path's segments. The longest entry on the way decides.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame

#: Most entries of a list, so that what is broadcast is bounded (about 100 MB).
MAX_ENTRIES = 1_000_000

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL).search
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; both empty for null and for a URL without `://`."""
    found = URL(url or "")
    return (found[1].translate(UPPER), found[2]) if found else ("", "")


def build_trie(entries) -> dict:
    """`entries`: (verdict, entry) such as ("block", "example.org/en/"); a later one replaces an equal one.

    A node maps labels to nodes. A node's "/" has the paths of that host: a trie of the
    segments that a slash ends. What comes after an entry's last slash may be the beginning
    of a segment; it is kept with the entry under `None`.
    """
    entries = list(entries)
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"{len(entries)} entries; {MAX_ENTRIES} at most")
    trie: dict = {}
    for verdict, entry in entries:
        if verdict not in ("allow", "block"):
            raise ValueError(f"not a verdict: {verdict}")
        host, slash, path = entry.partition("/")
        node = trie
        for label in reversed(host.translate(UPPER).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        *segments, start = (slash + path).split("/")
        for segment in segments:
            node = node.setdefault(segment, {})
        node.setdefault(None, {})[start] = entry, verdict
    return trie


def longest_match(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """The longest entry that fits, and its verdict; two times None if there is none.

    An entry fits its host and all subdomains, if the path starts with the entry's.
    """
    best, length = (None, None), -1
    node = trie
    parts = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        below = node.get("/")
        for k, part in enumerate(parts):
            if below is None:
                break
            for start, found in below.get(None, {}).items():
                if part.startswith(start) and len(found[0]) > length:
                    best, length = found, len(found[0])
            # Only segments that a slash ends lead on.
            below = below.get(part) if k < len(parts) - 1 else None
    return best


def judge(pages: DataFrame, entries, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    `rule` is null and the verdict `default` where no entry fits, so for null and malformed
    urls too, unless an entry's host is empty. Only page_id and url are read; repeated rows
    and null ids come back as they are, an empty table gives an empty result.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(entries))

    def run(batches):
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [longest_match(trie.value, host, path) for host, path in split]
            columns = [[h for h, _ in split], [p for _, p in split], [r for r, _ in found], [v or default for _, v in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast("int64"), *(pa.array(c, "string") for c in columns)], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select("page_id", "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
