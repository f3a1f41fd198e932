"""Exact merge-type encoding and decoding for a SentencePiece BPE model, by backtracking.

A text becomes pieces from left to right: an Aho-Corasick automaton over the vocabulary gives the longest
piece at a place, the next shorter pieces follow by its chain of prefixes, a piece is taken only if it is
compatible with the one before it (re-merging the two gives back just these two), and a bit field holds
the places from which no compatible continuation exists, so none is tried twice. The vocabulary has no
piece in which a space mark follows another character, so merges never cross the start of a run of
space marks and each such segment is encoded by itself; a bounded cache holds frequent segments.

Null texts count as empty (only the end id). White space of any kind is kept as the model keeps it,
repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import keeps, small

MARK = "▁"
END = 2
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Segments whose ids are kept, and pairs of pieces whose compatibility is, in two generations of so many.
CACHE, PAIRS = 1 << 17, 1 << 16
#: More than the rank of any piece.
NONE = 1 << 62
#: Texts are encoded and decoded in windows of about so many characters, each from the start of a run of space marks.
WINDOW = 1 << 16
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_EDGE = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """The text in stretches; a text without spaces is one."""
    at = 0
    while at < len(text):
        edge = _EDGE.search(text, at + size) if len(text) - at > size else None
        to = edge.start() if edge else len(text)
        yield text[at:to]
        at = to


class Made(dict):
    """Values made when they are first asked for, in two generations of so many; those of keys longer than `longest` aren't kept."""

    def __init__(self, make: Callable, most: int, longest: int | None = None):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        if (got := self.older.get(key)) is None:
            got = self.make(key)
        if self.longest is None or len(key) <= self.longest:
            if len(self) >= self.most:  # keys not met since the last such turn are forgotten
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


class Pieces:
    """The model's vocabulary and the encoder over it."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.score, self.text, self.byte = {}, {}, {}, {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[i] = int(piece[3:5], 16)
            elif not sp.is_control(i) and not sp.is_unknown(i):
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.text[i] = piece
        self.byte_id = {v: k for k, v in self.byte.items()}
        self.known = {c for p in self.ids for c in p}
        order = sorted(self.ids, key=lambda p: -self.score[p])
        self.rank, k = {}, -1
        for before, piece in zip([None, *order], order):  # pieces of one score have one rank
            k += before is None or self.score[before] != self.score[piece]
            self.rank[piece] = k
        whole = {p: i for p, i in self.ids.items() if self.merge(p) == [p]}  # others never stand in an encoding
        self.automaton = ahocorasick.Automaton()
        self.size, self.shorter = [0] * sp.vocab_size(), [-1] * sp.vocab_size()
        for piece, i in whole.items():
            self.automaton.add_word(piece, (len(piece) - 1, i))
            self.size[i], self.shorter[i] = len(piece), next((whole[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in whole), -1)
        self.automaton.make_automaton()
        self.edges = Made(self._edges, PAIRS)
        self.pairs = Made(lambda pair: self.compatible(self.text[pair >> 32], self.text[pair & 0xFFFFFFFF]), PAIRS)  # by both ids in one number
        self.bytes = [self.text[i].replace(MARK, " ").encode() if i in self.text else bytes([self.byte[i]]) if i in self.byte else b"" for i in range(sp.vocab_size())]
        self.number = list(map(str, range(sp.vocab_size())))
        self.words = Made(lambda segment: array("i", self.segment_ids(segment)).tobytes(), CACHE, 64)  # packed ids take less room than lists or text

    def merge(self, text: str) -> list[str]:
        """Merging from single characters: the best-scored adjacent pair first, the leftmost of equal ones."""
        parts, find = list(text), self.rank.get
        ranks = [find(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NONE:
            k = ranks.index(best)
            parts[k] += parts[k + 1]
            del parts[k + 1], ranks[k]
            if k:
                ranks[k - 1] = find(parts[k - 1] + parts[k], NONE)
            if k < len(ranks):
                ranks[k] = find(parts[k] + parts[k + 1], NONE)
        return parts

    def _edges(self, piece: str) -> tuple | None:
        """What stands at the left and at the right end of a piece while it is merged: for each end (text, rank it is made at), and a rank after all. None if ranks do not rise."""
        parts, find, left, right = list(piece), self.rank.get, [(piece[0], -1)], [(piece[-1], -1)]
        while len(parts) > 1:
            ranks = [find(a + b, NONE) for a, b in zip(parts, parts[1:])]
            k = ranks.index(best := min(ranks))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if k == 0:
                left.append((parts[0], best))
            if k == len(parts) - 1:
                right.append((parts[-1], best))
        for end in (left, right):
            if any(a[1] >= b[1] for a, b in zip(end, end[1:])):
                return None
            end.append(("", NONE))
        return left, right

    def compatible(self, left: str, right: str) -> bool:
        """Whether re-merging two pieces gives back just these two.

        They merge as each does by itself until what stands on both sides of the border makes a piece before either side's
        next merge at the border (on the left side at the same rank at the latest, as the leftmost goes first), so only the two ends are merged again.
        """
        first, second = self.edges[left], self.edges[right]
        if first is None or second is None:
            return self.merge(left + right) == [left, right]
        ends, starts, find, i, j = first[1], second[0], self.rank.get, 0, 0
        while True:
            rank, before, after = find(ends[i][0] + starts[j][0], NONE), ends[i + 1][1], starts[j + 1][1]
            if rank < before and rank <= after:
                return False
            if before == after == NONE:
                return True
            if before <= after:
                i += 1
            else:
                j += 1

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose every character is in the vocabulary.

        The automaton gives the longest piece at every place. From the left, the longest one that is compatible with the one
        before it is taken; where none is, the place is marked in the bit field and the piece before it gives way to its next shorter one.
        """
        n = len(text)
        longest = [-1] * (n + 1)
        for end, (k, i) in self.automaton.iter(text):  # longer ones from one place end later
            longest[end - k] = i
        out: list[int] = []
        at, i, last, failed, pairs, shorter, size = 0, longest[0], -1, None, self.pairs, self.shorter, self.size
        while at < n:
            while i >= 0:
                if last < 0 or pairs[last << 32 | i]:
                    to = at + size[i]
                    if failed is None or not failed[to >> 3] >> (to & 7) & 1:
                        break
                i = shorter[i]
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError("the vocabulary does not hold every character of the text")
                at -= size[out.pop()]
                i, last = shorter[last], out[-1] if out else -1
                continue
            out.append(i)
            at, last, i = to, i, longest[to]
        return out

    def segment_ids(self, text: str) -> list[int]:
        """Ids of one segment; characters outside the vocabulary become their bytes' pieces."""
        if self.known.issuperset(text):
            return self.backtrack(text)
        ids: list[int] = []
        for known, run in itertools.groupby(text, self.known.__contains__):
            run = "".join(run)
            ids += self.backtrack(run) if known else [self.byte_id[b] for b in run.encode("utf-8", "replace")]
        return ids

    def segments(self, text: str, first: bool = True) -> list[str]:
        """A stretch's segments: each starts at the start of a run of space marks; the first stretch of a text has one mark more."""
        marked = text.replace(" ", MARK)
        marked = MARK + marked if first else marked
        if MARK * 2 in marked:
            return _SEGMENT.findall(marked)
        return [MARK + w for w in marked[1:].split(MARK)]

    def stream(self, text: str | None) -> Iterator[list[int]]:
        """The ids, without the end id, a window of the text at a time."""
        for k, part in enumerate(windows(text or "")):
            yield array("i", b"".join(map(self.words.__getitem__, self.segments(part, not k)))).tolist()

    def encode(self, text: str | None) -> list[int]:
        return [*itertools.chain.from_iterable(self.stream(text)), END]

    def decode(self, ids: list[int]) -> str:
        reader = Reader(self)
        return reader.feed(ids) + reader.end()

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the text decoded from them; neither is held as a whole."""
        n, numbers, decoded, reader = 1, hashlib.sha256(), hashlib.sha256(), Reader(self)
        for ids in self.stream(text):
            n += len(ids)
            numbers.update((" ".join(map(self.number.__getitem__, ids)) + " ").encode())
            decoded.update(reader.feed(ids).encode())
        numbers.update(self.number[END].encode())
        decoded.update((reader.feed([END]) + reader.end()).encode())
        return n, numbers.hexdigest(), decoded.hexdigest()


class Reader:
    """Text of ids that arrive in stretches: byte pieces are read as UTF-8, whole runs of them, broken ones become U+FFFD; the text's leading space goes."""

    def __init__(self, pieces: Pieces):
        self.bytes, self.state, self.begun = pieces.bytes, codecs.getincrementaldecoder("utf-8")("replace"), False

    def _first(self, text: str) -> str:
        if self.begun or not text:
            return text
        self.begun = True
        return text[1:] if text[0] == " " else text

    def feed(self, ids: list[int]) -> str:
        return self._first(self.state.decode(b"".join(map(self.bytes.__getitem__, ids))))

    def end(self) -> str:
        return self._first(self.state.decode(b"", True))


@functools.lru_cache(2)
def load(path: str) -> Pieces:
    return Pieces(path)


keeps("pieces", load.cache_clear)


def _column(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def encode_decode(documents: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """Digests of each text's ids and of the text decoded from these ids; with full, the ids and the text too."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        pieces = load(model)
        for b in small(batches, owner="pieces"):
            texts = list(_column(b))
            got = [pieces.digests(t) for t in texts]
            cols = [b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                ids = [pieces.encode(t) for t in texts]
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array([pieces.decode(i) for i in ids], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, SCHEMA if full else DIGESTS)
