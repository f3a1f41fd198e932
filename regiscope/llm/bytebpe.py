"""Byte-level BPE encoding by a streaming transducer of bounded lookahead, and decoding by a byte-to-text state machine.

Merges of a proper list (both parts of a merge are bytes or made by earlier merges) are applied in the order of the list.
Text that follows changes tokens on its left only through a chain of merges of ever later rank: each takes, or is kept
from, the token on the left of the place up to which all is as before, and its right part grew from the left part of the
merge before it. The longest such chain, measured in bytes of left parts, is the list's sufficient lookahead: a token that
ends so many bytes before the end of what was read is stable. The transducer merges what it holds, gives out the stable
tokens and keeps the bytes after them, so it never holds more than the lookahead and one step, however long a word is.

Words are divided as the library's byte-level pre-tokenizer does. A text is read in stretches; a stretch is cut where a
space follows another character, where words always part; a word longer than that is recognised by its kind of character
(letters, digits, spaces, others) and goes through the transducer while it is read. The special token's text, which no
normalizer touches, becomes its id. Null texts count as empty (no ids). Repeated rows give repeated results, other columns are ignored.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import keeps, small

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SCHEMA = DIGESTS + ", ids array<long>, decoded string"
#: Words whose ids are kept, in two generations of so many; longer ones are not kept.
CACHE, KEPT = 1 << 17, 64
#: Characters of a stretch, and bytes that the transducer takes in one step.
WINDOW, STEP = 1 << 16, 1 << 10
#: Characters at the end of what was read that may still turn into a contraction or the special token.
BACK = 16
#: More than the rank of any pair.
NONE = 1 << 62
# The words of a byte-level pre-tokenizer, and the kinds of characters in them.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
KINDS = [regex.compile(k) for k in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]
_EDGE, _LAST_EDGE = regex.compile(r"(?<=\S)\s"), regex.compile(r"(?r)(?<=\S)\s")


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes at the end of a text that what follows can change at most, for merges in the order of their rank."""
    made: dict[bytes, list[bytes]] = {}  # left parts of the merges that make a token
    for a, b in merges:
        if any(len(t) != 1 and t not in made for t in (a, b)):
            raise ValueError("a merge comes before the merge that makes a part of it")
        made.setdefault(a + b, []).append(a)

    @functools.cache
    def grown_from(token: bytes) -> frozenset[bytes]:
        return frozenset({token}.union(*(grown_from(a) for a in made.get(token, ()))))

    furthest: dict[bytes, int] = {}  # by a token: the longest chain that goes on with a merge, of a rank tried already, whose right part grew from it
    most = 0
    for a, b in reversed(merges):
        reach = len(a) + furthest.get(a, 0)
        most = max(most, reach)
        for t in grown_from(b):
            furthest[t] = max(furthest.get(t, 0), reach)
    return most


class Model:
    """A byte-level BPE tokenizer file: vocabulary, merges and their lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("not a plain byte-level BPE tokenizer")
        at = byte_characters()
        to_bytes = lambda token: bytes(at[c] for c in token)
        ids = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [tuple(map(to_bytes, m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        self.lookahead = sufficient_lookahead(merges)
        self.byte = [ids[bytes([b])] for b in range(256)]
        self.pairs = {(ids[a], ids[b]): rank << 32 | ids[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(len(t) > BACK or regex.search(r"\s", t) for t in self.special):
            raise ValueError("a special token is longer than the text held back, or has a space")
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for raw, i in [*ids.items(), *((c.encode(), i) for c, i in self.special.items())]:
            self.bytes[i] = raw
        self.divide = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = Words(self)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of bytes: the first pair of the list at each time, the leftmost of equal ones."""
        ids = [self.byte[b] for b in raw]
        if len(ids) > KEPT:
            return self._merge_many(ids)
        find = self.pairs.get
        ranks = [find(p, NONE) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NONE:
            k = ranks.index(best)
            ids[k] = best & 0xFFFFFFFF
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = find((ids[k - 1], ids[k]), NONE)
            if k < len(ranks):
                ranks[k] = find((ids[k], ids[k + 1]), NONE)
        return ids

    def _merge_many(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs and links between neighbours."""
        n, pairs = len(ids), self.pairs
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(p, k, ids[k], ids[k + 1]) for k in range(n - 1) if (p := pairs.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            p, k, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j < 0 or ids[j] != b:
                continue
            ids[k], ids[j], after[k] = p & 0xFFFFFFFF, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right >= 0 and (p := pairs.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (p, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]


class Words(dict):
    """Packed ids by word, made when they are first asked for; in two generations of CACHE words each."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, word: str) -> bytes:
        if (got := self.older.get(word)) is None:
            raw = word.encode()
            if len(raw) > STEP:
                t = Transducer(self.model)
                got = pack(t.feed(raw) + t.end())
            else:  # one step of the transducer and its end
                got = pack(self.model.merge(raw))
        if len(word) <= KEPT:
            if len(self) >= CACHE:  # words not met since the last such turn are forgotten
                self.older = dict(self)
                self.clear()
            self[word] = got
        return got


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Transducer:
    """Bytes of one word in, stable tokens out."""

    def __init__(self, model: Model):
        self.model, self.held = model, b""

    def feed(self, raw: bytes) -> list[int]:
        out = []
        for at in range(0, len(raw), STEP):
            self.held += raw[at : at + STEP]
            stable = len(self.held) - self.model.lookahead
            if stable >= STEP // 2:
                done = 0
                for i in self.model.merge(self.held):
                    size = len(self.model.bytes[i])
                    if done + size > stable:
                        break
                    out.append(i)
                    done += size
                self.held = self.held[done:]
        return out

    def end(self) -> list[int]:
        raw, self.held = self.held, b""
        return self.model.merge(raw)


class Encoder:
    """Text in stretches of any size in, packed ids out; what is held is bounded, whatever the text."""

    def __init__(self, model: Model):
        self.model, self.held, self.kind, self.run = model, "", None, Transducer(model)

    def feed(self, text: str) -> bytes:
        return b"".join(self._feed(text[at : at + WINDOW]) for at in range(0, len(text), WINDOW))

    def _feed(self, text: str) -> bytes:
        self.held += text
        out = self._long() if self.kind else b""
        if self.kind:
            return out
        if edge := _LAST_EDGE.search(self.held):
            out += self._words(self.held[: edge.start()])
            self.held = self.held[edge.start() :]
        elif len(self.held) > WINDOW:
            out += self._begin()
        return out

    def end(self) -> bytes:
        """What is still held, as the end of the text."""
        out = self._long(end=True) if self.kind else b""
        out += self._words(self.held)
        self.held = ""
        return out

    def _words(self, text: str) -> bytes:
        """Ids of text that ends where words part."""
        parts = self.model.divide.split(text) if self.model.divide else [text]
        out = list(map(self.model.words.__getitem__, WORDS.findall(parts[0])))
        for token, part in zip(parts[1::2], parts[2::2]):
            out.append(pack([self.model.special[token]]))
            out += map(self.model.words.__getitem__, WORDS.findall(part))
        return b"".join(out)

    def _special(self) -> int:
        found = self.model.divide.search(self.held) if self.model.divide else None
        return found.start() if found else -1

    def _begin(self) -> bytes:
        """Text without an edge: the words that are complete, and then the start of a long one."""
        out, at = b"", self._special()
        if at >= 0:
            end = self.model.divide.match(self.held, at).end()
            out, self.held = self._words(self.held[:end]), self.held[end:]
            return out
        known, done = len(self.held) - BACK, 0
        for m in WORDS.finditer(self.held):
            if m.end() > known:
                break
            out += self.model.words[m.group()]
            done = m.end()
        self.held = self.held[done:]
        if len(self.held) > WINDOW // 2:
            self.kind = next(k for k in KINDS if k.match(self.held, 1))
            out += self._push(len(self.held) - BACK)
        return out

    def _push(self, n: int) -> bytes:
        ids = self.run.feed(self.held[:n].encode()) if n > 0 else []
        self.held = self.held[max(n, 0) :]
        return pack(ids)

    def _long(self, end: bool = False) -> bytes:
        """More of a long word."""
        at = self._special()
        upto = at if at >= 0 else len(self.held)
        m = self.kind.match(self.held, 0, upto)
        n = m.end() if m else 0
        if at < 0 and n > len(self.held) - BACK and not end:  # what follows the word, if it ends here, isn't known
            return self._push(len(self.held) - BACK)
        if self.kind is KINDS[2] and n < upto:  # the last space goes to the word after it
            n -= 1
        out = self._push(n) + pack(self.run.end())
        self.kind = None
        return out


class Reader:
    """Ids in stretches in, text out: a state machine over UTF-8 bytes, in which a character may be spread over tokens; broken bytes become U+FFFD."""

    def __init__(self, model: Model):
        self.bytes, self.state = model.bytes, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", True)


@functools.lru_cache(2)
def load(path: str) -> Model:
    return Model(path)


keeps("bytebpe", load.cache_clear)


def stream(model: Model, text: str | None) -> Iterator[bytes]:
    """Packed ids of a text, a stretch at a time."""
    encoder, text, at = Encoder(model), text or "", 0
    while at < len(text):
        edge = _EDGE.search(text, at + WINDOW) if len(text) - at > WINDOW else None
        to = min(edge.start() + 1 if edge else len(text), at + 2 * WINDOW)
        yield encoder.feed(text[at:to])
        at = to
    yield encoder.end()


def digests(model: Model, text: str | None) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the packed ids and of the text decoded from them; neither is held as a whole."""
    n, packed_hash, text_hash, reader = 0, hashlib.sha256(), hashlib.sha256(), Reader(model)
    for packed in stream(model, text):
        n += len(packed) // 4
        packed_hash.update(packed)
        text_hash.update(reader.feed(np.frombuffer(packed, "<u4").tolist()).encode())
    text_hash.update(reader.end().encode())
    return n, packed_hash.hexdigest(), text_hash.hexdigest()


def encode(model: Model, text: str | None) -> list[int]:
    return np.frombuffer(b"".join(stream(model, text)), "<u4").tolist()


def decode(model: Model, ids: list[int]) -> str:
    reader = Reader(model)
    return reader.feed(ids) + reader.end()


def encode_decode(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """Digests of each text's ids and of the text decoded from these ids; with full, the ids and the text too. `tokenizer` is a file that all executors have."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        model = load(tokenizer)
        for b in small(batches, owner="bytebpe"):
            got = [digests(model, t.as_py()) for t in b.column("text")]
            cols = [b.column("doc_id"), *(pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string())))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                ids = [encode(model, t.as_py()) for t in b.column("text")]
                cols += [pa.array(ids, pa.list_(pa.int64())), pa.array([decode(model, i) for i in ids], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, SCHEMA if full else DIGESTS)
