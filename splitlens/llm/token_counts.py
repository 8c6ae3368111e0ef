"""Token counts of a byte-level BPE vocabulary with a whole-token shortcut.

A pre-token that is a vocabulary string is not always one token: the merges
may never build it.  So it is proved once, on the driver, which strings of the vocabulary
encode alone as one token, by merging each.  A text's pre-tokens are looked up
in that table and count one; only the rest is merged, each distinct one once per
task and memory window.

The tables have the vocabulary's size and are broadcast.  Counts equal the ``tokenizers``
library's: special strings inside a text are cut out first and count one
token each; there is no normalizer, prefix space, truncation or padding.

Defined results: a NULL text counts as empty; an empty text has no tokens; a NULL id
stays NULL; repeated rows get a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import ship_by_value

ship_by_value(__name__)

# The pre-token pattern of byte-level BPE files with "use_regex".
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 500_000        # merged pre-tokens a task remembers before it starts anew


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the file: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges, least rank first, leftmost of equal rank
    first.  A heap over a linked list: n log n also for very long pre-tokens."""
    symbols, n = list(symbols), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
            if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue                                # one of the two has been merged since
        symbols[i], symbols[j] = left + right, ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (r := ranks.get((symbols[a], symbols[b]))) is not None:
                heapq.heappush(heap, (r, a, symbols[a], symbols[b]))
    return [s for s in symbols if s]


class Vocabulary:
    """What counting needs from a tokenizer file: merge ranks, special strings,
    and the strings proved to be whole tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = (model["type"] == "BPE" and pre["type"] == "ByteLevel" and pre["use_regex"]
                 and not pre["add_prefix_space"] and spec["normalizer"] is None and not model["dropout"]
                 and not model.get("ignore_merges") and not model["continuing_subword_prefix"] and not model["end_of_word_suffix"])
        if not plain:
            raise ValueError("only plain byte-level BPE files are supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take blanks or word edges with them are not supported")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {p: r for r, p in enumerate(pairs)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        to_byte = {c: b for b, c in byte_symbols().items()}
        self.whole = {}
        for piece in model["vocab"]:
            try:
                text = bytes(to_byte[c] for c in piece).decode()
            except (KeyError, UnicodeDecodeError):
                continue                            # no text has this as a pre-token
            if merged(list(piece), self.ranks) == [piece]:
                self.whole[text] = 1


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens), with ``n_whole``, the tokens that the shortcut
    counted."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path).__dict__)

    def run(batches):
        import regex

        known = vocabulary.value
        ranks, symbols, whole = known["ranks"], byte_symbols(), known["whole"]
        words = regex.compile(PATTERN).findall
        special = regex.compile("|".join(regex.escape(s) for s in sorted(known["special"], key=len, reverse=True)) or r"(?!)")

        class Counts(dict):
            """Pre-token -> tokens; merges what it does not know."""

            def __missing__(self, word):
                n = len(merged([symbols[b] for b in word.encode()], ranks))
                if len(self) > REMEMBERED:
                    self.clear()
                if len(word) < 256:
                    self[word] = n
                return n

        rest = Counts()

        def count(text):
            n = one = 0
            for part in special.split(text):
                for word in words(part):
                    if word in whole:
                        one += 1
                    else:
                        n += rest[word]
            return n + one + len(special.findall(text)), one

        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                found = [count(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.int64())], ["id", "n_bytes", "n_tokens", "n_whole"])

    kind = dict(docs.dtypes)[id_col]
    text = F.col(text_col).cast("string")
    counted = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                          F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes")).mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, n_whole long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"), "n_whole")
