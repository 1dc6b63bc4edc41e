"""Byte-level BPE: speculate with the longest tokens, verify neighbours, merge only what fails.

A text is cut into words by a fixed pattern. For each new word the longest token that
fits is taken again and again. A row of tokens is what merging would give exactly if
every two neighbours would also stay apart alone; that is tested for all pairs of a
batch at once by undoing their merges, latest first. Words with a failing pair are
merged step by step.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelworks.llm import kernel

# Fixed value: how byte-level tokenizers of this kind cut a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NEVER = 1 << 40
_LONG_WORD = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class _Index(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Encoder:
    """A tokenizer file and the words encoded so far (at most about ``remember``)."""

    def __init__(self, path: str, remember: int = 200_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if odd or model["type"] != "BPE" or spec["normalizer"] or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        letters = byte_letters()
        self.remember = remember
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping, whole-word or normalising rules are not supported")
        kinds = sorted(self.added, key=len, reverse=True)
        self.longest_added = max(map(len, kinds), default=0)
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, kinds)) + ")") if kinds else None
        self.cut_words = regex.compile(WORD_PATTERN)
        vocab: dict[str, int] = model["vocab"]
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.single = np.full(256, -1, dtype=np.int64)
        for i in vocab.values():
            if len(self.bytes_of[i]) == 1:
                self.single[self.bytes_of[i][0]] = i
        # A token's rank is the place of the merge that makes it; single bytes have -1.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for place, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = vocab[a + b]
            self.merges[vocab[a], vocab[b]] = (place, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = place, vocab[a], vocab[b]
        pairs = np.array([(a << 20) | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(pairs)
        self.pair_key = pairs[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        made = np.flatnonzero(self.rank >= 0)
        whole = np.zeros(size, dtype=bool)
        whole[made] = self._apart(self.left[made], self.right[made], self.rank[made])
        # A token is proposed only if merging its bytes gives it, so both parts must be such too.
        for i in made[np.argsort(self.rank[made])].tolist():
            parts = (int(self.left[i]), int(self.right[i]))
            whole[i] &= all(self.rank[p] < 0 or whole[p] for p in parts)
        self._plant([i for i in vocab.values() if len(self.bytes_of[i]) == 1 or whole[i]])
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.ids = np.zeros(0, dtype=np.int32)
        self.count = np.zeros(0, dtype=np.int64)
        self.start = np.zeros(0, dtype=np.int64)

    def _plant(self, tokens: list[int]) -> None:
        """A tree of the tokens' bytes: children by (node, byte), and the token that ends at a node."""
        child: dict[int, int] = {}
        ends = [-1]
        for token in tokens:
            node = 0
            for b in self.bytes_of[token]:
                key = node << 8 | b
                if key not in child:
                    child[key] = len(ends)
                    ends.append(-1)
                node = child[key]
            ends[node] = token
        self.child = child
        self.node_end = np.array(ends, dtype=np.int64)
        keys = np.array(list(child), dtype=np.int64)
        order = np.argsort(keys)
        self.edge, self.edge_to = keys[order], np.array(list(child.values()), dtype=np.int64)[order]

    def _apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge ever joins across the border of ``a`` and ``b`` before ``limit``.

        Going back in time, the later made of both border tokens is undone. A merge across
        the border wins if its place is before that of the merge undone last; for equal
        places the one further left comes first.
        """
        ok = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        limit = np.full(len(a), _NEVER, dtype=np.int64) if limit is None else limit
        while len(live):
            key = (a << 20) | b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            joins = (self.pair_key[at] == key) & (self.pair_rank[at] < limit)
            ok[live[joins]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~joins & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            live = live[go]
        return ok

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the earliest merge, the leftmost of equals."""
        ids = [int(self.single[b]) for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := self.merges.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := self.merges.get((made, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1], made, ids[k]))
            h = before[i]
            if h >= 0 and (m := self.merges.get((ids[h], made))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], made))
        return [x for x in ids if x >= 0]

    def _propose_long(self, word: bytes) -> list[int]:
        out, at = [], 0
        while at < len(word):
            node, best, step = 0, -1, 1
            for i in range(at, len(word)):
                node = self.child.get(node << 8 | word[i], -1)
                if node < 0:
                    break
                if self.node_end[node] >= 0:
                    best, step = int(self.node_end[node]), i + 1 - at
            out.append(best)
            at += step
        return out

    def _propose(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens for all words at once: (word, token) in order."""
        words, tokens = [], []
        live, at, stop = np.arange(len(offs) - 1), offs[:-1].copy(), offs[1:]
        go = at < stop
        live, at, stop = live[go], at[go], stop[go]
        while len(live):
            best, step = np.full(len(live), -1), np.ones(len(live), dtype=np.int64)
            on, node, depth = np.arange(len(live)), np.zeros(len(live), dtype=np.int64), 0
            while len(on):
                on_at = at[on] + depth
                inside = on_at < stop[on]
                on, node, on_at = on[inside], node[inside], on_at[inside]
                key = (node << 8) | data[on_at]
                edge = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
                found = self.edge[edge] == key
                on, node = on[found], self.edge_to[edge[found]]
                depth += 1
                ends = self.node_end[node]
                best[on[ends >= 0]] = ends[ends >= 0]
                step[on[ends >= 0]] = depth
            words.append(live)
            tokens.append(best)
            at = at + step
            go = at < stop
            live, at, stop = live[go], at[go], stop[go]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, end to end, and how many each has."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(w) for w in raw], dtype=np.int64)
        long = np.flatnonzero(size > _LONG_WORD).tolist()
        short = [b"" if len(w) > _LONG_WORD else w for w in raw]
        offs = np.concatenate([[0], np.cumsum([len(w) for w in short], dtype=np.int64)])
        word, token = self._propose(np.frombuffer(b"".join(short), dtype=np.uint8), offs)
        if long:
            proposed = [self._propose_long(raw[i]) for i in long]
            word = np.concatenate([word, np.repeat(long, [len(p) for p in proposed])])
            token = np.concatenate([token, *[np.array(p, dtype=np.int64) for p in proposed]])
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique((token[inner] << 20) | token[inner + 1], return_inverse=True)
        apart = self._apart(pairs >> 20, pairs & ((1 << 20) - 1))
        failed = np.unique(word[inner[~apart[which]]])
        if len(failed):
            merged = [self.merge(raw[i]) for i in failed.tolist()]
            keep = ~np.isin(word, failed)
            word = np.concatenate([word[keep], np.repeat(failed, [len(m) for m in merged])])
            token = np.concatenate([token[keep], *[np.array(m, dtype=np.int64) for m in merged]])
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        return token.astype(np.int32), np.bincount(word, minlength=len(words)).astype(np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The place of each word in ``count`` and ``start``; new words are encoded."""
        if len(self.index) > self.remember:
            self._forget()
        known = len(self.index)
        out = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.index) > known:
            fresh = list(self.index)[known:]
            ids, count = self.encode_words(fresh)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids])
        return out

    def split_from(self, text: str, at: int = 0) -> Iterator[str]:
        """The words of a text from a place between two words on, found as they are asked for."""
        while at < len(text):
            hit = self.cut_added.search(text, at) if self.cut_added is not None else None
            for m in self.cut_words.finditer(text, at, hit.start() if hit else len(text)):
                yield m.group()
            if not hit:
                return
            yield hit.group()
            at = hit.end()

    def split(self, text: str) -> list[str]:
        """All words of a text; the string of an added token is one word."""
        if self.cut_added is None or not self.cut_added.search(text):
            return self.cut_words.findall(text)
        return list(self.split_from(text))

    def count_words(self, words: list[str]) -> np.ndarray:
        """How many tokens each word has."""
        number = self.numbers(words)
        count = self.count[number]
        if not self.added.keys().isdisjoint(words):
            count[[i for i, w in enumerate(words) if w in self.added]] = 1
        return count

    def count_few(self, words: list[str]) -> list[int]:
        """As ``count_words``, for so few words that unknown ones are merged one by one."""
        out = []
        for w in words:
            if w in self.added:
                out.append(1)
            elif w in self.index:
                out.append(int(self.count[self.index[w]]))
            else:
                out.append(len(self.merge(w.encode("utf-8", "surrogatepass"))))
        return out

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and the bounds of each text."""
        words: list[str] = []
        sizes, added = [], []
        for t in texts:
            if self.cut_added is not None and self.cut_added.search(t):
                for i, piece in enumerate(self.cut_added.split(t)):
                    if i % 2:
                        added.append((len(words), self.added[piece]))
                        words.append(piece)
                    else:
                        words += self.cut_words.findall(piece)
            else:
                words += self.cut_words.findall(t)
            sizes.append(len(words))
        number = self.numbers(words)
        count, start = self.count[number], self.start[number]
        ids = self.ids
        if added:  # an added token is one id, whatever its string would be as a word
            at, own = np.array(added).T
            ids = np.concatenate([ids, own.astype(np.int32)])
            count[at], start[at] = 1, len(self.ids) + np.arange(len(own))
        sums = np.concatenate([[0], np.cumsum(count)])
        flat = ids[np.repeat(start - sums[:-1], count) + np.arange(sums[-1])]
        return flat, sums[np.array([0, *sizes], dtype=np.int64)]


class Decoder:
    """The bytes of every token of a tokenizer file, and nothing else of it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bytes_of = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            bytes_of[i] = token.encode()
        self.lengths = np.array([len(b) for b in bytes_of], dtype=np.int64)
        self.body = np.frombuffer(b"".join(bytes_of), dtype=np.uint8)
        self.body_start = np.cumsum(self.lengths) - self.lengths

    def decode_batch(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of rows of ids; bytes that are no UTF-8 become replacement characters."""
        size = self.lengths[ids]
        sums = np.concatenate([[0], np.cumsum(size)])
        data = self.body[np.repeat(self.body_start[ids] - sums[:-1], size) + np.arange(sums[-1])].tobytes()
        cuts = sums[bounds].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_encoders: dict[str, Encoder] = {}
_decoders: dict[str, Decoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once per worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decoder(path: str) -> Decoder:
    """The decoder of a file, loaded once per worker."""
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]


def _kinds(docs: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)


def encode(docs: DataFrame, path: str, text: str = "text", batch_bytes: int = 2 << 20) -> DataFrame:
    """Add ``ids`` (array of int): the tokens of the whole text by the tokenizer file at ``path``.

    Strings of added tokens inside a text become those tokens. Null and empty texts give an
    empty array. A column named ``ids`` is replaced; rows are independent of each other, so
    repeated rows get equal ids and an empty table stays empty. ``path`` must exist on
    every executor.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column(text))[1], batch_bytes):
                part = batch.slice(a, b - a)
                ids, bounds = tool.encode_batch([t or "" for t in part.column(text).to_pylist()])
                column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(run, _kinds(docs) + "ids array<int>")


def encode_checked(docs: DataFrame, path: str, text: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``ids`` (array of int) in place of the text, and ``round_trip``: whether they decode to it.

    Both ways run in one worker, over small parts of a batch, and neither the text nor what
    its tokens decode to leaves it. Null and empty texts give an empty array that decodes to
    them. Columns named like an added one are replaced; repeated rows get equal results, and an
    empty table stays empty. ``path`` must exist on every executor.
    """
    keep = [c for c in docs.columns if c not in (text, "ids", "round_trip")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, back = encoder(path), decoder(path)
        for batch in batches:
            for a, b in kernel.slices(kernel.flat(batch.column(text))[1], batch_bytes):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column(text).to_pylist()]
                ids, bounds = tool.encode_batch(texts)
                same = [x == y for x, y in zip(texts, back.decode_batch(ids, bounds), strict=True)]
                column = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.select(keep).columns, column, pa.array(same, pa.bool_())], names=[*keep, "ids", "round_trip"]
                )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name in keep)
    return docs.mapInArrow(run, kinds + "ids array<int>, round_trip boolean")


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the tokens in ``ids``; a null array or null id gives no text."""
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = decoder(path)
        for batch in batches:
            column = batch.column(ids)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            tops = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            flat = pc.list_flatten(column)
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(known)])[tops]
            for a, b in kernel.slices(bounds, 1 << 19):
                mine = flat.drop_null().slice(bounds[a], bounds[b] - bounds[a]).to_numpy(zero_copy_only=False)
                texts = tool.decode_batch(mine, bounds[a : b + 1] - bounds[a])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, _kinds(rows) + f"`{out}` string")
