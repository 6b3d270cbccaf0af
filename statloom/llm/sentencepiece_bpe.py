"""SentencePiece BPE encoding and decoding as vectorised merge rounds.

The vocabulary is read from a public model file (never trained here). A text
is escaped (spaces become U+2581, one is put in front) and cut into words: a
run of U+2581 with what follows it. No piece of the vocabulary has U+2581
after another character, so no merge crosses such a cut (checked on load).

Words of a block are encoded together, each distinct word once:

* symbols of all words lie in one flat array of piece ids;
* each neighbouring pair has a rank (position of the joined piece among the
  vocabulary by score), looked up in a sorted table of pairs;
* a round takes the smallest rank of every word (segmented minimum) and
  merges its occurrences from the left, all words at once;
* arrays are compacted, words without a mergeable pair leave, and rounds go
  on until no pair remains.

The library merges one pair at a time: best score first, leftmost on a tie.
Merging all occurrences of the best pair in one round is the same as long as
no merge of the round makes a pair that ranks before it. Where one does, the
word stops that round behind it, so the order is the library's in every case.

Characters outside the vocabulary become their UTF-8 byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from statloom.llm import flat

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
NO_RANK = np.iinfo(np.int32).max
#: Encoded words remembered during a task; beyond it the memory starts anew.
REMEMBERED_WORDS = 300_000

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol-buffer message: (number, value)."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if tag & 7 == 1 else (4, at) if tag & 7 == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Model:
    """Pieces, pair ranks and flags of a SentencePiece BPE model file."""

    def __init__(self, data: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f.get(1, b"").decode("utf-8"), float(np.frombuffer(f[2], "<f4")[0]) if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError("a BPE model with byte fallback and white space in front is needed")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("a model with the identity normaliser, a dummy prefix and white space kept is needed")
        if any(kind in (USER, UNUSED) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = [p for p, _, _ in pieces]
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece has white space after other characters")
        self.byte_id = np.zeros(256, np.int32)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
        self.end = self.pieces.index("</s>")
        # a lower rank is merged first; equal scores share a rank
        scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        n = self.size = len(pieces)
        pairs = sorted((normal[p[:k]] * n + normal[p[k:]], rank[pieces[i][1]], i)
                       for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal)
        self.pair, self.rank, self.joined = (np.array(x, t) for x, t in zip(zip(*pairs, strict=True), (np.int64, np.int32, np.int32), strict=True))
        self.slots = self._slots()
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(SPACE, " ").encode("utf-8")
                      for p, _, kind in pieces]
        self.is_byte = np.array([kind == BYTE for _, _, kind in pieces])

    def _slots(self) -> np.ndarray:
        """Open-addressing table over the pairs: slot -> index of a pair, or -1."""
        bits = max(4, int(len(self.pair) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        slots = np.full(1 << bits, -1, np.int32)
        self.probes = 0
        left = np.arange(len(self.pair))
        while len(left):
            place = (self._slot(self.pair[left]) + self.probes) & (len(slots) - 1)
            free = slots[place] < 0
            slots[place[free]] = left[free]  # the last one to claim a slot has it
            left = left[slots[place] != left]
            self.probes += 1
        return slots

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * flat.ODD) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined piece) of each pair; NO_RANK where they don't join."""
        key = left.astype(np.int64) * self.size + right
        rank, joined = np.full(len(key), NO_RANK, np.int32), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        slot = self._slot(key)
        for probe in range(self.probes):
            found = self.slots[(slot[todo] + probe) & (len(self.slots) - 1)]
            same = (found >= 0) & (self.pair[found] == key[todo])
            rank[todo[same]], joined[todo[same]] = self.rank[found[same]], self.joined[found[same]]
            todo = todo[(found >= 0) & ~same]
            if not len(todo):
                break
        return rank, joined

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Initial symbols of words, flat, and the number of each word's symbols."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        own = self.char_id[code]
        missing = np.flatnonzero(own < 0)
        if not len(missing):
            return own, size
        spelt = [self.byte_id[list(chr(c).encode("utf-8"))] for c in code[missing].tolist()]
        times = np.ones(len(code), np.int64)
        times[missing] = [len(x) for x in spelt]
        word = np.repeat(np.arange(len(words)), size)
        out = np.repeat(own, times)
        out[out < 0] = np.concatenate(spelt)
        return out, np.bincount(word, times, len(words)).astype(np.int64)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, flat, and the number of ids of each word."""
        symbol, size = self.symbols(words)
        n = len(symbol)
        word = np.repeat(np.arange(len(words)), size)
        done_symbol, done_word = [], []
        rank, joined = np.full(n, NO_RANK, np.int32), np.zeros(n, np.int32)
        if n > 1:
            rank[:-1], joined[:-1] = self.look_up(symbol[:-1], symbol[1:])
            rank[:-1][word[:-1] != word[1:]] = NO_RANK
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(symbol)))
            ended = best == NO_RANK
            if ended.any():  # these words are finished: they leave the arrays
                out = np.repeat(ended, count)
                done_symbol.append(symbol[out])
                done_word.append(word[out])
                symbol, word, rank, joined = symbol[~out], word[~out], rank[~out], joined[~out]
                best, count = best[~ended], count[~ended]
                if not len(symbol):
                    break
            symbol, word, rank, joined = self._round(symbol, word, rank, joined, np.repeat(best, count))
        if not done_symbol:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def _round(self, symbol, word, rank, joined, best):
        """Merge the best pair of every word, leftmost first, as far as the order allows."""
        at = np.flatnonzero(rank == best)
        # neighbouring occurrences overlap: of a run take the 1st, 3rd, ...
        run = np.concatenate([[True], at[1:] != at[:-1] + 1])
        start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - start) % 2 == 0]
        at = self._in_order(symbol, word, joined, best, at)
        symbol[at] = joined[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        new = (np.cumsum(keep) - 1)[at]
        symbol, word, rank, joined = symbol[keep], word[keep], rank[keep], joined[keep]
        changed = np.zeros(len(symbol) + 1, bool)  # pairs with a merged symbol on the right or on the left
        changed[new], changed[new - 1] = True, True
        touched = np.flatnonzero(changed[: len(symbol) - 1])
        if len(touched):
            r, j = self.look_up(symbol[touched], symbol[touched + 1])
            r[word[touched] != word[touched + 1]] = NO_RANK
            rank[touched], joined[touched] = r, j
        rank[-1] = NO_RANK
        return symbol, word, rank, joined

    def _in_order(self, symbol, word, joined, best, at):
        """Drop the occurrences that come after a merge which makes a better pair in the same word."""
        again = np.flatnonzero(word[at[1:]] == word[at[:-1]])  # only words with several occurrences matter
        if not len(again):
            return at
        several = np.zeros(int(word[-1]) + 1, bool)
        several[word[at[again]]] = True
        mine = np.flatnonzero(several[word[at]])
        made, better = joined[at[mine]], np.zeros(len(mine), bool)
        place = np.full(len(symbol), -1, np.int64)
        place[at] = np.arange(len(at))
        # at the time of a merge its left neighbour may be merged already, the right one is not yet
        left = at[mine] - 1
        before = np.where((left >= 1) & (place[np.maximum(left - 1, 0)] >= 0), left - 1, left)
        piece = np.where(place[np.maximum(before, 0)] >= 0, joined[np.maximum(before, 0)], symbol[np.maximum(before, 0)])
        ok = (left >= 0) & (word[np.maximum(left, 0)] == word[at[mine]])
        r, _ = self.look_up(piece, made)
        better |= ok & (r < best[at[mine]])
        right = np.minimum(at[mine] + 2, len(symbol) - 1)
        ok = (at[mine] + 2 < len(symbol)) & (word[right] == word[at[mine]])
        r, _ = self.look_up(made, symbol[right])
        better |= ok & (r < best[at[mine]])
        if not better.any():
            return at
        stop: dict[int, int] = {}
        for k in mine[better].tolist():
            stop.setdefault(int(word[at[k]]), k)
        last = np.full(len(at), len(at))
        for w, k in stop.items():
            last[word[at] == w] = k
        return at[np.arange(len(at)) <= last]

    def encode(self, texts: list[str], memory: dict[str, bytes]) -> list[np.ndarray]:
        """Ids of whole texts (without an end id). ``memory`` keeps words that were encoded before."""
        cut = [_cut_words(t) for t in texts]
        fresh = list(set().union(*cut) - memory.keys())
        ids, size = self.encode_words(fresh)
        end = np.cumsum(size) * 4
        raw = ids.astype("<i4").tobytes()
        memory.update(zip(fresh, (raw[a:b] for a, b in zip((end - size * 4).tolist(), end.tolist(), strict=True)), strict=True))
        return [np.frombuffer(b"".join(map(memory.__getitem__, ws)), "<i4") for ws in cut]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces in a row, byte pieces read as UTF-8 (bad ones become U+FFFD), the space in front dropped."""
        if not len(ids):
            return ""
        out: list[str] = []
        cuts = np.flatnonzero(np.diff(self.is_byte[ids].astype(np.int8))) + 1
        for part in np.split(ids, cuts):
            raw = b"".join([self.bytes[i] for i in part.tolist()])
            out.append(_read_bytes(raw) if self.is_byte[part[0]] else raw.decode("utf-8"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text


def _read_bytes(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that starts no valid character."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode("utf-8"))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def _cut_words(text: str) -> list[str]:
    """Escaped words of a text: each begins with its run of U+2581."""
    if not text:
        return []
    return _WORD.findall(SPACE + text.replace(" ", SPACE))


_MODELS: dict[int, Model] = {}
_MEMORY: dict[str, bytes] = {}


def _model(data: bytes) -> Model:
    key = hash(data)
    if key not in _MODELS:
        _MODELS.clear()
        _MEMORY.clear()
        _MODELS[key] = Model(data)
    return _MODELS[key]


def _run(file, extra: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(file.value)
        for block in flat.blocks(batches, size=flat.BLOCK_BYTES // 8):
            if len(_MEMORY) > REMEMBERED_WORDS:
                _MEMORY.clear()
            ids = [np.append(x, np.int32(model.end)) for x in model.encode([t or "" for t in block.column("text").to_pylist()], _MEMORY)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            made = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids), pa.int32())),
                    pa.array([model.decode(x) for x in ids], pa.string())]
            columns = [*(block.column(c) for c in extra), *made]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        _MEMORY.clear()
        flat.give_back()

    return run


def encode_decode(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode each whole text with an end id, and decode the ids again.

    Returns doc_id, the columns in ``keep``, ids array<int> and decoded string.
    The model file is read where the query is planned and broadcast (its size
    is fixed). NULL is encoded like the empty text: the end id alone, decoded
    to the empty text. Rows are independent of each other, so ties, repeats
    and empty tables need no rule. Columns not named are ignored.
    """
    with open(model_path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    extra = ["doc_id", *keep]
    out = StructType([*docs.select(*extra).schema.fields, *StructType.fromDDL("ids array<int>, decoded string").fields])
    chosen = docs.select(*dict.fromkeys([*extra, "text"]))
    return chosen.mapInArrow(_run(file, extra, to_arrow_schema(out)), out)


def _digest(file, extra: list[str], schema: pa.Schema):
    inner = pa.schema([*(schema.field(c) for c in extra), pa.field("ids", pa.list_(pa.int32())), pa.field("decoded", pa.string())])
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = [str(i) for i in range(_model(file.value).size)]
        for done in _run(file, extra, inner)(batches):
            ids = done.column("ids")
            off = ids.offsets.to_pylist()
            spelt = [text[i] for i in ids.values.to_pylist()]
            made = {
                "n_tokens": pa.array(np.diff(ids.offsets.to_numpy()), pa.int64()),
                "ids_sha256": pa.array([sha(" ".join(spelt[a:b]).encode()) for a, b in zip(off[:-1], off[1:], strict=True)]),
                "decoded_sha256": pa.array([sha(t.encode("utf-8")) for t in done.column("decoded").to_pylist()]),
                "ids": ids,
            }
            columns = [done.column(c) for c in extra] + [made[c] for c in schema.names[len(extra) :]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def digests(docs: DataFrame, model_path: str, keep: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """``encode_decode`` reduced, inside the same tasks, to doc_id, the columns in ``keep``,
    n_tokens, ids_sha256 and decoded_sha256 (and the ids themselves, if asked for)."""
    with open(model_path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    extra = ["doc_id", *keep]
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    out = StructType([*docs.select(*extra).schema.fields, *StructType.fromDDL(made).fields])
    return docs.select(*dict.fromkeys([*extra, "text"])).mapInArrow(_digest(file, extra, to_arrow_schema(out)), out)
