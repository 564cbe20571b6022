"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A byte-level BPE tokenizer first cuts text into pre-tokens by a pattern and never merges across
them, so a document's token count is the sum over its pre-tokens. A document keeps their lengths
and counts in chunks, under a segment tree of sums. An edit re-cuts text from a little before
it (the pattern looks ahead by ``AHEAD`` characters at most) until a cut falls on an old one after
it: from there on nothing changes, as the pattern does not look back. Only the new pre-tokens are
encoded, and only the sums above their chunks are updated.

* ``trees`` makes the trees of a table, ``edited`` applies a table of edits to them,
* ``recount`` counts before and after the edits that a rule proposes, in one pass without a shuffle.

Cases: null text has count 0 and no edits apply. Edits are (start, end, replacement) in characters
of the text before all edits, cut to its length; a null replacement is empty. They apply in order
of start, end and replacement, and one that starts before the end of the one before is left out.
Rows that share a doc_id get the same edits. A null doc_id gets none. Texts are read whole. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows, slices

CHUNK = 64
AHEAD = 3
Edit = tuple[int, int, str]

_PRIVATE = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|\d{3,}")


def scrub(text: str) -> list[Edit]:
    """Rule: e-mail addresses become ``<email>`` and runs of three or more digits ``0``."""
    return [(m.start(), m.end(), "<email>" if "@" in m[0] else "0") for m in _PRIVATE.finditer(text)]


class Encoder:
    """Pre-tokens and their token counts through a bounded cache."""

    def __init__(self, path: str | None = None, most: int = 300_000):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known, self.most = regex.compile(public_tokenizers.PATTERN), {}, most

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = len(self.encoding.encode_ordinary(p))
        return [known[p] for p in pieces]


class Tree:
    """Segment tree of (characters, tokens) over chunks of pre-tokens."""

    def __init__(self, sizes: list[int], counts: list[int]):
        self.sizes = [sizes[i:i + CHUNK] for i in range(0, len(sizes), CHUNK)] or [[]]
        self.counts = [counts[i:i + CHUNK] for i in range(0, len(counts), CHUNK)] or [[]]
        self.leaves = 1 << (len(self.sizes) - 1).bit_length()
        self.sums = [[0, 0] for _ in range(2 * self.leaves)]
        for i, (s, c) in enumerate(zip(self.sizes, self.counts)):
            self.sums[self.leaves + i] = [sum(s), sum(c)]
        for i in range(self.leaves - 1, 0, -1):
            self.sums[i] = [a + b for a, b in zip(self.sums[2 * i], self.sums[2 * i + 1])]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def find(self, offset: int) -> tuple[int, int, int]:
        """(chunk, number in it, start) of the pre-token that holds the character at ``offset`` (the end if past all)."""
        node, start = 1, 0
        while node < self.leaves:
            node *= 2
            if offset >= start + self.sums[node][0]:
                start += self.sums[node][0]
                node += 1
        chunk = min(node - self.leaves, len(self.sizes) - 1)
        if chunk < node - self.leaves:
            return chunk, len(self.sizes[chunk]), self.sums[1][0]
        for i, n in enumerate(self.sizes[chunk]):
            if offset < start + n:
                return chunk, i, start
            start += n
        return chunk, len(self.sizes[chunk]), start

    def replace(self, a: tuple[int, int], b: tuple[int, int], sizes: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in place of those from ``a`` up to ``b``, each (chunk, number)."""
        (ca, ia), (cb, ib) = a, b
        for rows, new in ((self.sizes, sizes), (self.counts, counts)):
            after = rows[cb][ib:]
            rows[ca] = rows[ca][:ia] + new + (after if ca == cb else [])
            for c in range(ca + 1, cb):
                rows[c] = []
            if ca != cb:
                rows[cb] = after
        touched = range(ca, cb + 1)
        for c in touched:
            self.sums[self.leaves + c] = [sum(self.sizes[c]), sum(self.counts[c])]
        up = {(self.leaves + c) // 2 for c in touched}
        while up - {0}:
            for i in up:
                self.sums[i] = [x + y for x, y in zip(self.sums[2 * i], self.sums[2 * i + 1])]
            up = {i // 2 for i in up} - {0}


def build(text: str, encoder: Encoder) -> Tree:
    pieces = encoder.pattern.findall(text)
    return Tree([len(p) for p in pieces], encoder.counts(pieces))


def in_order(edits: Iterable, length: int) -> list[Edit]:
    """Edits cut to the text, sorted, without those that overlap an earlier one."""
    out, end = [], 0
    for s, e, r in sorted((min(max(0, s), length), min(max(0, s, e), length), r or "") for s, e, r in edits
                          if s is not None and e is not None):
        if s >= end:
            out.append((s, e, r))
            end = e
    return out


def apply(text: str, tree: Tree, edits: list[Edit], encoder: Encoder) -> tuple[str, int]:
    """(new text, pre-tokens encoded anew); ``tree`` is updated in place. Edits as by ``in_order``."""
    parts, at = [], 0
    for s, e, r in edits:
        parts += [text[at:s], r]
        at = e
    new = "".join([*parts, text[at:]])
    # From the right, so that what lies to the left still has its old offsets in the tree.
    shift, regions, k = 0, [], 0
    while k < len(edits):
        s, e, r = edits[k]
        start = tree.find(max(0, s - AHEAD))[2]
        at, pieces = start + shift, []
        shift += len(r) - (e - s)
        edge = e + shift
        while True:
            while k + 1 < len(edits) and edits[k + 1][0] - AHEAD < at - shift + AHEAD:     # the next edit is in reach
                k += 1
                s, e, r = edits[k]
                shift += len(r) - (e - s)
                edge = e + shift
            if at >= edge and (at == len(new) or tree.find(at - shift)[2] == at - shift):
                break
            m = encoder.pattern.match(new, at)
            pieces.append(m[0])
            at = m.end()
        regions.append((start, at - shift, pieces))
        k += 1
    for start, end, pieces in reversed(regions):
        a, b = tree.find(start)[:2], tree.find(end)[:2]
        tree.replace(a, b, [len(p) for p in pieces], encoder.counts(pieces))
    return new, sum(len(x[2]) for x in regions)


def recount(docs: DataFrame, rule: Callable[[str], list[Edit]] = scrub, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_pretokens, n_tokens, n_edits, n_encoded (pre-tokens encoded anew), n_tokens_after."""
    names = ["doc_id", "n_pretokens", "n_tokens", "n_edits", "n_encoded", "n_tokens_after"]

    def count(batches):
        encoder = Encoder(path)
        for b in slices(batches):
            out = []
            for doc_id, text in rows(b, "doc_id", "text"):
                text = text or ""
                tree = build(text, encoder)
                edits, before = in_order(rule(text), len(text)), tree.tokens
                n = sum(map(len, tree.sizes))
                anew = apply(text, tree, edits, encoder)[1] if edits else 0
                out.append((doc_id, n, before, len(edits), anew, tree.tokens))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(count, ", ".join(f"{n} long" for n in names))


def trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text, sizes, counts, n_tokens): the pre-tokens' lengths and token counts as arrays."""
    def make(batches):
        encoder = Encoder(path)
        for b in slices(batches):
            out = []
            for doc_id, text in rows(b, "doc_id", "text"):
                pieces = encoder.pattern.findall(text or "")
                counts = encoder.counts(pieces)
                out.append((doc_id, text, [len(p) for p in pieces], counts, sum(counts)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES)], names=NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, SCHEMA)


NAMES = ["doc_id", "text", "sizes", "counts", "n_tokens"]
TYPES = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
SCHEMA = "doc_id long, text string, sizes array<int>, counts array<int>, n_tokens long"


def edited(state: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """``trees`` after ``edits`` (doc_id, start, end, replacement), plus n_encoded."""
    def change(batches):
        encoder = Encoder(path)
        for b in slices(batches):
            out = []
            for doc_id, text, sizes, counts, n, todo in rows(b, *NAMES, "edits"):
                anew = 0
                if todo and text is not None:
                    tree = Tree(sizes, counts)
                    text, anew = apply(text, tree, in_order([(x["start"], x["end"], x["replacement"]) for x in todo], len(text)), encoder)
                    sizes, counts, n = [x for c in tree.sizes for x in c], [x for c in tree.counts for x in c], tree.tokens
                out.append((doc_id, text, sizes, counts, n, anew))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*TYPES, pa.int64()])],
                                                 names=[*NAMES, "n_encoded"])

    per_doc = edits.where("doc_id is not null").groupBy("doc_id") \
        .agg(F.collect_list(F.struct("start", "end", "replacement")).alias("edits"))
    return state.join(per_doc, "doc_id", "left").select(*NAMES, "edits").mapInArrow(change, SCHEMA + ", n_encoded long")
