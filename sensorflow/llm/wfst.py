"""SentencePiece encoding and decoding as the shortest path through a weighted finite-state transducer.

The transducer is compiled from a model file in three parts, composed lazily with each input:

* the *normaliser* (space escaping, dummy prefix, removal of extra white space) maps characters to characters;
* the *pieces*: an arc per vocabulary piece. In a unigram model it weighs minus the piece's score. In a BPE model
  a state remembers the last piece, and an arc to the next one weighs 0 if merging their joined characters
  gives back exactly these two pieces, else infinity; a sequence all of whose neighbours pass is the BPE
  encoding and no other sequence is, so the only path of finite weight is the model's own encoding;
* *byte fallback*: a character that is no piece is the path of its UTF-8 bytes' pieces.

Encoding takes the shortest path in the tropical semiring (min, +) over (position, last piece). No piece can
span two characters that stand side by side in no piece, so the path is cut there; segments between such cuts
are encoded one by one and short ones remembered in a table of bounded size, which changes no result.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame

from sensorflow.llm.common import MEMOS, id_type, map_texts, pick

SPACE = "▁"
CACHED, CACHED_CHARS = 1 << 19, 32
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """``(number, value)`` of the fields of a protocol-buffers message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class _Always(dict):
    """The state before the first piece, or after a character's bytes: every arc is allowed."""

    def get(self, key, default=None):
        return True


@dataclass
class Transducer:
    """A compiled model; see the module's text. ``kind`` is UNIGRAM or BPE."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    kind: int
    dummy_prefix: bool = True
    strip_extra: bool = False
    ids: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == 2), 0)
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == 6}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (1, 4)}
        self.trie: dict = {}  # by character; the piece that ends at a node stands under ""
        for p, i in self.ids.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = i
        self.raw = [bytes([int(p[1:-1], 16)]) if k == 6 else " \u2047 ".encode() if k == 2 else b"" if k == 3
                    else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds)]
        inner = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        self.pairs = inner
        # Cuts that no piece spans: before an escaped space, around line feeds, and after a run of the
        # characters that can follow a letter inside a piece, if they are followed by another character.
        run = {chr(c) for c in range(0x61, 0x7B)}
        while more := {b for a, b in inner if a in run} - run:
            run |= more
        if not any(b == SPACE and a != SPACE for a, b in inner) and not {SPACE, "\n"} & run and not any("\n" in p for p in self.ids):
            r = "".join(map(re.escape, sorted(run)))
            self.segment = re.compile(f"{SPACE}*[{r}]+|{SPACE}*[^{r}{SPACE}\n]+[{r}]*|{SPACE}+|\n")
        else:
            self.segment = re.compile("(?s).+")
        usual = [s for s, k in zip(self.scores, self.kinds) if k == 1]
        self.unknown_cost = 10.0 - min(usual, default=0.0)
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._fits: dict[int, dict[int, bool]] = {-1: _Always()}
        self._known = 0

    # ---- composition with one segment

    def _merge(self, text: str) -> list[str]:
        """Greedy BPE of a short text: the pair with the best score is merged first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = min(((-self.scores[i], at) for at, (a, b) in enumerate(zip(parts, parts[1:]))
                        if (i := self.ids.get(a + b)) is not None), default=None)
            if best is None:
                return parts
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether the arc from last piece ``a`` to piece ``b`` has finite weight in a BPE model."""
        if self._known >= 1 << 20:
            self._fits, self._known = {-1: self._fits[-1]}, 0
        x, y = self.pieces[a], self.pieces[b]
        fits = x[-1] + y[0] not in self.pairs or self._merge(x + y) == [x, y]
        self._fits.setdefault(a, {})[b] = fits
        self._known += 1
        return fits

    def shortest_path(self, text: str) -> list[int]:
        """Ids on the path of least weight through the lattice of one segment.

        Arcs of infinite weight are not followed. In a BPE model one path of finite weight at most leads to a
        position, so a state per position is enough there too. Unknown characters go through their bytes.
        """
        n, trie, bpe, nothing = len(text), self.trie, self.kind == BPE, {}
        last: list[int | None] = [None] * (n + 1)  # piece into each position; -1: a character's bytes
        back, weight = [0] * (n + 1), [0.0] + [float("inf")] * n
        last[0] = -1
        for at in range(n):
            before = last[at]
            if before is None:
                continue
            node = trie.get(text[at], nothing)
            if "" not in node:
                w = weight[at] + self.unknown_cost
                if w < weight[at + 1]:
                    last[at + 1], back[at + 1], weight[at + 1] = -1, at, w
            fits, end = self._fits.get(before, nothing), at + 1
            while node:
                piece = node.get("")
                if piece is not None:
                    if bpe:
                        if last[end] is None:
                            ok = fits.get(piece)
                            if ok or ok is None and self._neighbours(before, piece):
                                last[end], back[end], weight[end] = piece, at, weight[at]
                    elif weight[at] - self.scores[piece] < weight[end]:
                        last[end], back[end], weight[end] = piece, at, weight[at] - self.scores[piece]
                if end == n:
                    break
                node = node.get(text[end])
                end += 1
        out: list[int] = []
        at = n
        while at > 0:
            if last[at] >= 0:
                out.append(last[at])
            else:
                raw = text[back[at]:at].encode("utf-8", "surrogatepass")
                out.extend([self.bytes[b] for b in reversed(raw)] if len(self.bytes) == 256 else [self.unknown])
            at = back[at]
        return out[::-1]

    # ---- whole texts

    def normalise(self, text: str) -> str:
        if self.strip_extra:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def _segment_ids(self, segment: str) -> bytes:
        out = self.older.get(segment)
        if out is None:
            out = array("i", self.shortest_path(segment)).tobytes()
        if len(segment) <= CACHED_CHARS:
            if len(self.memory) >= CACHED:  # what was not used since the last turn is forgotten
                self.memory, self.older = {}, self.memory
            self.memory[segment] = out
        return out

    def encode(self, text: str | None) -> array:
        """Piece ids; none for a null or empty text."""
        out = array("i")
        if text:
            out.frombytes(b"".join([self.memory.get(s) or self._segment_ids(s) for s in self.segment.findall(self.normalise(text))]))
        return out

    def decode(self, ids) -> str:
        """Text of piece ids: byte pieces are joined to characters (wrong bytes to U+FFFD), control pieces dropped."""
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8")
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def _decode_runs(self, ids) -> str:
        """Runs of byte pieces that are no UTF-8 give U+FFFD for each wrong byte."""
        parts, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == 6:
                run += self.raw[i]
                continue
            while run:
                size = next((n for n in range(min(4, len(run)), 0, -1) if _is_character(run[:n])), 0)
                parts.append(run[:size].decode("utf-8") if size else "\ufffd")
                del run[:size or 1]
            if i is not None:
                parts.append(self.raw[i].decode("utf-8"))
        return "".join(parts)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


def compile_model(data: bytes, kind: int | None = None) -> Transducer:
    """The transducer of a serialised SentencePiece model with an identity normaliser; ``kind`` overrides its type."""
    import struct
    pieces, scores, kinds, own, norm = [], [], [], UNIGRAM, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode("utf-8"))
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, 1))
        elif number == 2:
            own = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            norm = dict(_fields(value))
    if norm.get(2):
        raise ValueError("only models without a character map are supported")
    kind = kind or own
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return Transducer(pieces, scores, kinds, kind, bool(norm.get(3, 1)), bool(norm.get(4, 1)))


@lru_cache(maxsize=2)
def _worker_model(data: bytes) -> Transducer:
    return compile_model(data)


MEMOS[__name__] = _worker_model.cache_clear


def encode_texts(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` (array of int) and ``n_tokens``, ``round_trip`` (the ids decode to the text), a row per row of ``df``.

    ``model`` is the serialised model (half a megabyte), broadcast once. Null and empty texts have no ids and
    decode to the empty text. A text's own U+2581 is the escaped space and decodes to a space, as in the
    original library; round_trip compares with that. Repeated rows keep a row each; extra columns are ignored.
    """
    docs = pick(df, id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def step(batch: dict) -> dict:
        import numpy as np
        import pyarrow as pa
        fst = _worker_model(shared.value)
        ids = [fst.encode(t) for t in batch["text"]]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.frombuffer(b"".join(ids), dtype=np.int32)
        if len(flat) < 1 << 31:
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        else:
            lists = pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))
        same = [fst.decode(i) == (t or "").replace(SPACE, " ") for i, t in zip(ids, batch["text"])]
        return {"id": batch["id"], "ids": lists, "n_tokens": sizes.tolist(), "round_trip": same}
    return map_texts(docs, step, f"id {id_type(docs)}, ids array<int>, n_tokens bigint, round_trip boolean")


def decode_ids(df: DataFrame, model: bytes, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` of the ids; null or empty ids give the empty text."""
    rows = pick(df, id=id_col, ids=ids_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def step(batch: dict) -> dict:
        fst = _worker_model(shared.value)
        return {"id": batch["id"], "text": [fst.decode(i or []) for i in batch["ids"]]}
    return map_texts(rows, step, f"id {id_type(rows)}, text string")
