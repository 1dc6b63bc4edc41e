"""Token counts that follow edits without counting a document anew.

A document is cut into words, as its tokenizer cuts it; a tree over runs of words holds
characters and tokens of every subtree. An edit cuts anew from the word before the first
touched one (a cut looks one character ahead) until a cut of the new text falls on an old
one behind the edit; from there on the old words stand. Only leaves in between change, and
sums on their paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import kernel
from parcelworks.llm.bpe import Encoder, encoder
from parcelworks.llm.names import sets_aside

_LEAF = 64


class SegmentTree:
    """Runs of words (text lengths and token counts) under a balanced tree of sums.

    Node ``i`` has children ``2i`` and ``2i + 1``; leaves hold at most ``4 * _LEAF`` words.
    A leaf that outgrows this makes the tree be built again from its leaves.
    """

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self._build(chars, tokens)

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.chars = [chars[i : i + _LEAF] for i in range(0, len(chars), _LEAF)] or [[]]
        self.tokens = [tokens[i : i + _LEAF] for i in range(0, len(tokens), _LEAF)] or [[]]
        self.size = 1
        while self.size < len(self.chars):
            self.size *= 2
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        self.sums[self.size : self.size + len(self.chars)] = [
            (sum(c), sum(t)) for c, t in zip(self.chars, self.tokens, strict=True)
        ]
        low = self.size
        while low > 1:
            level = self.sums[low : 2 * low].reshape(-1, 2, 2).sum(axis=1)
            low //= 2
            self.sums[low : 2 * low] = level

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, char: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the word that holds a character; the last word at the end."""
        if char >= self.n_chars:
            char = max(0, self.n_chars - 1)
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if char >= before + self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        leaf = node - self.size
        for place, n in enumerate(self.chars[leaf] if leaf < len(self.chars) else ()):
            if char < before + n:
                return leaf, place, before
            before += n
        return leaf, 0, before

    def step_back(self, leaf: int, place: int, first: int) -> tuple[int, int, int]:
        """The word before; the first word has none and stays."""
        while not place:
            if not leaf:
                return 0, 0, first
            leaf -= 1
            place = len(self.chars[leaf])
        return leaf, place - 1, first - self.chars[leaf][place - 1]

    def replace(self, start: tuple[int, int], drop: int, chars: list[int], tokens: list[int]) -> int:
        """Put words in place of the words that cover ``drop`` characters from ``start`` on; returns how many went."""
        leaf, place = start
        gone, touched = 0, {leaf}
        at, here = leaf, place
        while drop > 0:
            n = self.chars[at][here:]
            k, held = 0, 0
            while k < len(n) and held < drop:
                held += n[k]
                k += 1
            del self.chars[at][here : here + k], self.tokens[at][here : here + k]
            drop -= held
            gone += k
            touched.add(at)
            at, here = at + 1, 0
        if drop:
            raise ValueError("an edit must end between words")
        self.chars[leaf][place:place] = chars
        self.tokens[leaf][place:place] = tokens
        if len(self.chars[leaf]) > 4 * _LEAF:
            self._build([n for c in self.chars for n in c], [n for t in self.tokens for n in t])
            return gone
        for i in touched:
            node = self.size + i
            self.sums[node] = sum(self.chars[i]), sum(self.tokens[i])
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
        return gone


class CountedText:
    """A text, its words in a tree, and how many words were counted for edits so far."""

    def __init__(self, tool: Encoder, text: str, words: list[str], tokens: np.ndarray) -> None:
        self.tool, self.text = tool, text
        self.tree = SegmentTree([len(w) for w in words], tokens.tolist())
        self.n_words, self.recounted = len(words), 0

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` to ``end`` (clipped to the text) by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        back = self.tool.longest_added
        # An added token may form across the edit: begin so far before it that none can be cut.
        leaf, place, first = self.tree.find(max(0, start - back))
        leaf, place, first = self.tree.step_back(leaf, place, first)
        text = self.text[:start] + new + self.text[end:]
        shift = len(text) - len(self.text)
        words: list[str] = []
        stop = len(text)
        at = first
        settled = start + len(new) + back
        for word in self.tool.split_from(text, first):
            if at >= settled and self._is_border(at - shift):
                stop = at
                break
            words.append(word)
            at += len(word)
        count = self.tool.count_few(words)
        gone = self.tree.replace((leaf, place), stop - shift - first, [len(w) for w in words], count)
        self.text = text
        self.n_words += len(words) - gone
        self.recounted += len(words)

    def _is_border(self, char: int) -> bool:
        if char >= self.tree.n_chars:
            return char == self.tree.n_chars
        return self.tree.find(char)[2] == char


@sets_aside("__id", "__text", "__edits")
def count_edited(
    docs: DataFrame,
    edits: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    batch_bytes: int = 4 << 20,
) -> DataFrame:
    """Token counts of documents before and after their edits.

    ``edits`` has ``doc_id``, ``step``, ``start``, ``end`` and ``new``: in the order of
    ``step``, characters from ``start`` to ``end`` of the text as it then is are replaced by
    ``new``. Returns one row per document: all columns of ``docs`` but the text, ``n_edits``,
    ``n_words`` and ``n_tokens`` after the edits, ``n_tokens_before``, ``n_recounted`` (words
    that edits made be encoded) and ``edited_text``.

    Null texts count as empty, null places as 0 and null new text as empty; places outside a
    text are clipped to it. Edits of one step go by start, end, new text. Rows that share an
    id get the same edits each; edits without a document have no effect, nor do those with a
    null id. Edits of one document form one cell, so they meet in one task.
    """
    added = ["n_edits", "n_words", "n_tokens", "n_tokens_before", "n_recounted", "edited_text"]
    keep = [c for c in docs.columns if c not in (*added, text)]
    zero = lambda name: F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name)
    packed = F.struct(zero("step"), zero("start"), zero("end"), F.coalesce("new", F.lit("")).alias("new"))
    lists = edits.groupBy(F.col(doc_id).alias("__id")).agg(F.sort_array(F.collect_list(packed)).alias("__edits"))
    joined = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text")).join(
        lists, F.col(f"`{doc_id}`") == F.col("__id"), "left"
    )
    return count_packed(joined.drop("__id"), path, keep, batch_bytes)


def count_packed(rows: DataFrame, path: str, keep: list[str], batch_bytes: int = 4 << 20) -> DataFrame:
    """As ``count_edited``, for rows that hold their text and edits already (``__text``, ``__edits``)."""
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], "__text", "__edits")
    names = ["n_edits", "n_words", "n_tokens", "n_tokens_before", "n_recounted", "edited_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column("__text"))[1], batch_bytes):
                part = batch.slice(a, b - a)
                found: list[list] = [[] for _ in names]
                texts = [t or "" for t in part.column("__text").to_pylist()]
                words = [tool.split(t) for t in texts]
                cuts = np.cumsum([0, *map(len, words)]).tolist()
                tokens = tool.count_words([w for ws in words for w in ws])
                for k, (body, edits) in enumerate(zip(texts, part.column("__edits").to_pylist(), strict=True)):
                    counted = CountedText(tool, body, words[k], tokens[cuts[k] : cuts[k + 1]])
                    before = counted.tree.n_tokens
                    for e in edits or ():
                        counted.edit(e["start"], e["end"], e["new"])
                    values = (len(edits or ()), counted.n_words, counted.tree.n_tokens, before, counted.recounted, counted.text)
                    for column, value in zip(found, values, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 5 + [pa.string()]
                columns = [pa.array(c, k) for c, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, *columns], names=[*keep, *names])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name in keep)
    return rows.mapInArrow(
        run,
        kinds + "n_edits long, n_words long, n_tokens long, n_tokens_before long, n_recounted long, edited_text string",
    )
