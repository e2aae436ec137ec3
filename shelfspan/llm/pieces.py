"""Encoding and decoding with a merge-type SentencePiece vocabulary.

An agenda holds all adjacent symbol pairs whose concatenation is a piece. The
pair of the best score, and among equals the leftmost, is merged until none is
left. Characters that remain unknown become byte pieces.

No piece of a merge-type vocabulary has a space mark behind another character,
so words are independent: the agenda runs once for each different word, for
all new words of an Arrow batch side by side, and a bounded cache keeps the
ids. The rule is read from the vocabulary; where it does not hold, a whole
text is one word. Every text is checked against the library in the same batch.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfspan.llm.text import column_of, slices, strings

MARK = "▁"
#: Words over this many characters go through a heap, shorter ones side by side.
SIDE_BY_SIDE = 40
#: Different words a Python worker keeps, in two generations: the older one goes when the younger holds half of them.
CACHE_WORDS = 700_000
NONE = np.int64(1 << 40)


class Agenda:
    """The merge rules of one vocabulary file and the encoder that follows them."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        normal = {
            self.library.id_to_piece(i): i
            for i in range(size)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))
        }
        self.bytes = {int(self.library.id_to_piece(i)[1:-1], 16): i for i in range(size) if self.library.is_byte(i)}
        self.unknown = self.library.unk_id()
        # Characters that occur in pieces only get numbers behind the vocabulary.
        ids = dict(normal)
        for piece in normal:
            for c in piece:
                ids.setdefault(c, size + len(ids))
        self.size = size
        self.width = max(ids.values()) + 2
        self.outside = self.width - 1
        self.char_ids = np.full(0x110000, self.outside, np.int32)
        for c, i in ids.items():
            if len(c) == 1:
                self.char_ids[ord(c)] = i
        scores = {i: self.library.get_score(i) for i in normal.values()}
        rank = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (rank[scores[i]], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] or [0], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()] or [0], np.int32)
        self.pairs = pairs
        inside = {c for piece in normal if len(piece) > 1 for c in piece}
        if any(MARK in piece.lstrip(MARK) for piece in normal):
            self.words = re.compile(r"[\s\S]+")
        elif "\n" in inside:
            self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.words = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        #: A vocabulary may ask for a mark before the first word of a text.
        self.prefix = MARK if self.library.normalize("a").startswith(MARK) else ""
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.first = np.array([self.library.bos_id()], "<u4").tobytes()
        self.last = np.array([self.library.eos_id()], "<u4").tobytes()

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if the pair is no piece) and merged id of each pair."""
        wanted = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return np.where(found, self.ranks[at], NONE), self.merged[at]

    def _as_bytes(self, symbols, chars: str) -> bytes:
        """Ids in little-endian bytes; unknown characters, in their order, as byte pieces."""
        out, at = [], 0
        for s in symbols:
            if s < self.size:
                out.append(s)
                at += self.lengths[s]
            else:
                raw = chars[at].encode()
                out.extend(self.bytes[b] for b in raw) if self.bytes else out.append(self.unknown)
                at += 1
        return np.array(out, "<u4").tobytes()

    @property
    def lengths(self) -> list[int]:
        if not hasattr(self, "_lengths"):
            self._lengths = [len(self.library.id_to_piece(i)) for i in range(self.size)]
        return self._lengths

    def by_heap(self, word: str) -> bytes:
        """The agenda as a heap over a linked list: any length in n log n steps."""
        symbols = self.char_ids[np.frombuffer(word.encode("utf-32-le"), np.uint32)].tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n and (hit := self.pairs.get(symbols[left] * self.width + symbols[right])):
                heapq.heappush(agenda, (hit[0], left, right, symbols[left], symbols[right], hit[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, was_left, was_right, merged = heapq.heappop(agenda)
            if symbols[left] != was_left or symbols[right] != was_right or after[left] != right:
                continue
            symbols[left], symbols[right] = merged, -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return self._as_bytes([s for s in symbols if s >= 0], word)

    def side_by_side(self, words: list[str]) -> list[bytes]:
        """One row of symbols for each word; every round merges the best pair of every row."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        out: list[bytes] = [b""] * len(words)
        for low, high in ((1, 1), (2, 4), (5, 7), (8, 10), (11, 14), (15, 20), (21, SIDE_BY_SIDE)):
            rows = order[(lengths[order] >= low) & (lengths[order] <= high)]
            if not len(rows):
                continue
            width = int(lengths[rows].max())
            symbols = np.full((len(rows), width), self.outside, np.int32)
            flat = self.char_ids[np.frombuffer("".join([words[r] for r in rows]).encode("utf-32-le"), np.uint32)]
            symbols[np.arange(width)[None, :] < lengths[rows][:, None]] = flat
            counts = lengths[rows].copy()
            ranks, merged = self._look(symbols[:, :-1], symbols[:, 1:])
            while len(rows):
                if symbols.shape[1] > 1:
                    best = ranks.argmin(1)
                    live = ranks[np.arange(len(rows)), best] < NONE
                else:
                    best, live = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
                self._finish(words, out, rows[~live], symbols[~live], counts[~live])
                rows, symbols, ranks, merged, best, counts = rows[live], symbols[live], ranks[live], merged[live], best[live], counts[live] - 1
                if not len(rows):
                    break
                each = np.arange(len(rows))
                symbols[each, best] = merged[each, best]
                keep = np.ones(symbols.shape, bool)
                keep[each, best + 1] = False
                symbols = symbols[keep].reshape(len(rows), -1)
                keep = np.ones(ranks.shape, bool)
                keep[each, best] = False
                ranks, merged = ranks[keep].reshape(len(rows), -1), merged[keep].reshape(len(rows), -1)
                for shift in (-1, 0):
                    at = best + shift
                    ok = (at >= 0) & (at < ranks.shape[1])
                    r, a = each[ok], at[ok]
                    ranks[r, a], merged[r, a] = self._look(symbols[r, a], symbols[r, a + 1])
        return out

    def _finish(self, words, out, rows, symbols, counts) -> None:
        if not len(rows):
            return
        used = np.arange(symbols.shape[1])[None, :] < counts[:, None]
        strange = ((symbols >= self.size) & used).any(1)
        raw = symbols[used].astype("<u4").tobytes()
        ends = np.cumsum(counts) * 4
        for row, odd, end, count, line in zip(rows.tolist(), strange.tolist(), ends.tolist(), counts.tolist(), symbols, strict=True):
            out[row] = self._as_bytes(line[:count].tolist(), words[row]) if odd else raw[end - 4 * count : end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, with begin and end, as little-endian 32-bit integers."""
        split = [self.words.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        met = set().union(*split)
        if len(self.cache) > CACHE_WORDS // 2:
            self.old, self.cache = self.cache, {}
        cache = self.cache
        new = met.difference(cache)
        # Words that are still met move on to the younger generation.
        known = new.intersection(self.old)
        cache.update((w, self.old[w]) for w in known)
        new -= known
        short = [w for w in new if len(w) <= SIDE_BY_SIDE]
        cache.update(zip(short, self.side_by_side(short), strict=True))
        cache.update((w, self.by_heap(w)) for w in new if len(w) > SIDE_BY_SIDE)
        ids = {w: cache[w] for w in met}.__getitem__  # smaller than the cache, so looked up faster
        out = [self.first + b"".join(map(ids, words)) + self.last for words in split]
        for w in new:
            if len(w) > 200:  # long and hardly met again
                del cache[w]
        return out

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


@lru_cache(maxsize=2)
def agenda(path: str) -> Agenda:
    return Agenda(path)


def vocabulary_path(name: str) -> str:
    """The file of an installed public vocabulary; every node has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", keep_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256, agrees``.

    Null and empty texts hold the begin and the end id alone. Equal rows give
    equal rows. ``agrees`` tells whether the library gives the same ids;
    ``keep_ids`` adds the ids and the decoded text.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"
    schema += ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = agenda(vocabulary_path(vocabulary))
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in slices(batches):
            texts = strings(batch)
            coded = coder.encode(texts)
            theirs = [coder.library.encode_as_numpy(t, add_bos=True, add_eos=True).astype("<u4", copy=False).tobytes() for t in texts]
            decoded = [coder.decode(ids) for ids in coded]
            columns = [
                column_of(batch, "doc_id"),
                pa.array([len(ids) // 4 for ids in coded], pa.int64()),
                pa.array(map(sha, coded), pa.string()),
                pa.array([sha(d.encode()) for d in decoded], pa.string()),
                pa.array([a == b for a, b in zip(theirs, coded, strict=True)], pa.bool_()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
            if keep_ids:
                columns += [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(ids) // 4 for ids in coded]]), pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4"))), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
