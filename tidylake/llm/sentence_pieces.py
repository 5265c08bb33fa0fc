"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The library merges, over and over, the adjacent pair of symbols whose joint piece has
the best score, the leftmost of equals.  No merge can cross a border that no piece
holds inside, so a text falls into *words* (a run of spaces and what follows it, cut
further between characters that stand side by side in no piece), and words are
independent of each other.  All new words of a batch are encoded together:

1. their symbols lie in one flat numpy array, with the pair rank of each symbol and
   its right neighbour (rank by score; no piece, no rank);
2. a round takes the minimum of (rank, place) over each word's segment - the word's
   best pair, leftmost of equals - and merges all words' pairs at once;
3. ranks next to the merged places are looked up anew, the arrays are compacted, and
   words without a pair leave; until none is left.

One merge per word and round is the library's own order, so the pieces are the same.
A word of over ``LONG_WORD`` symbols is merged alone with a heap in the same order:
rounds would read it as often as it has merges.  Symbols that are no piece become
byte pieces.

The model file's path is a parameter; the file is read once on the driver and sent to
the tasks.  The words of a batch are found over one array of its bytes and told apart by
Arrow's dictionary encoding; their ids are looked up once per distinct word and gathered by
numpy.  Words are remembered per Python worker, up to a number of bytes, in two
generations: when the younger is full, the older goes, except for what was met again
meanwhile.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidylake.llm.bpe import joined, offset_table
from tidylake.llm.common import distinct, ref

SPACE = "▁"  # stands for a space in pieces
LONG_WORD = 256
#: Bytes of words and ids that a worker remembers, and of text that is encoded at once.
REMEMBERED_BYTES = 128_000_000
SLICE_BYTES = 4_000_000
_NONE = np.int64(2**62)
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def _byte_by_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _utf8(data: bytes) -> str:
    """Text of byte pieces; each byte outside a character is one U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        codecs.register_error("tidylake-bytes", _byte_by_byte)
        return data.decode("utf-8", "tidylake-bytes")


class Pieces:
    """Encoder and decoder of one BPE model file of the sentencepiece library."""

    def __init__(self, model: bytes):
        message = list(_fields(model))
        trainer = dict(_fields(next((v for f, v in message if f == 2), b"")))
        normalizer = dict(_fields(next((v for f, v in message if f == 3), b"")))
        found = [dict(_fields(v)) for f, v in message if f == 1]
        pieces = [p[1].decode() for p in found]
        kinds = np.array([p.get(3, _NORMAL) for p in found])
        self.dummy_prefix = bool(normalizer.get(3, 1))
        if (trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0)
                or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1)
                or not np.isin(kinds, (_NORMAL, _UNKNOWN, _CONTROL, _BYTE)).all()):
            raise ValueError("a BPE model with byte pieces and no normalisation is needed")
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()
        self.kinds = kinds
        scores = np.frombuffer(b"".join(p.get(2, bytes(4)) for p in found), "<f4")
        self.bytes = np.zeros(256, np.int64)
        for i in np.flatnonzero(kinds == _BYTE):
            self.bytes[int(pieces[i][1:-1], 16)] = i
        usable = {pieces[i]: int(i) for i in np.flatnonzero(kinds == _NORMAL)}
        # symbols: pieces, then characters that are inside pieces only
        letters = sorted({c for p in usable for c in p} - set(usable))
        self.spare = len(pieces)
        self.spare_letters = letters
        symbols = usable | {c: self.spare + i for i, c in enumerate(letters)}
        self.letters = {ord(s): i for s, i in symbols.items() if len(s) == 1}
        ranks = np.unique(-scores, return_inverse=True)[1]
        pairs, inside = {}, set()
        for piece, whole in usable.items():
            for n in range(1, len(piece)):
                inside.add(ord(piece[n - 1]) << 32 | ord(piece[n]))
                a, b = symbols.get(piece[:n]), symbols.get(piece[n:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = int(ranks[whole]), whole
        if any(p.lstrip(SPACE).count(SPACE) for p in usable):
            raise ValueError("a piece holds a space behind another character")
        self.inside = np.array(sorted(inside), np.int64)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks, self.wholes = (np.array([pairs[k][i] for k in self.keys.tolist()], np.int64)
                                   for i in (0, 1))
        strings = [b"" if k == _CONTROL else self.unknown.encode() if k == _UNKNOWN
                   else bytes([int(p[1:-1], 16)]) if k == _BYTE
                   else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kinds)]
        self.strings = offset_table(strings)
        self.numbers = offset_table([b"%d," % i for i in range(len(pieces))])
        self.plain = (kinds == _NORMAL) | (kinds == _BYTE)
        self.memory = _Memory()

    # -- encoding ---------------------------------------------------------------

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols (no piece: ``_NONE``, -1)."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        good = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(good, self.ranks[at], _NONE), np.where(good, self.wholes[at], -1)

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (and the word of each) after all merges; ``word`` ascends."""
        done_symbols, done_words = [], []
        rank, whole = np.full(len(symbols), _NONE), np.full(len(symbols), -1)
        if len(symbols):
            rank[:-1], whole[:-1] = self._lookup(symbols[:-1], symbols[1:])
            rank[:-1][word[1:] != word[:-1]] = _NONE
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(starts, append=len(word))
            ended = np.repeat(best == _NONE, lengths)
            if ended.any():  # words without a pair leave
                done_symbols.append(symbols[ended])
                done_words.append(word[ended])
                stay = ~ended
                symbols, word, rank, whole = symbols[stay], word[stay], rank[stay], whole[stay]
                best = best[best < _NONE]
                if not len(symbols):
                    break
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                lengths = np.diff(starts, append=len(word))
            hits = np.flatnonzero(rank == np.repeat(best, lengths))
            at = hits[np.unique(word[hits], return_index=True)[1]]  # leftmost of each word
            symbols[at] = whole[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            at = place[at]
            symbols, word, rank, whole = symbols[stay], word[stay], rank[stay], whole[stay]
            touched = np.concatenate([at, at - 1])
            touched = touched[touched >= 0]
            right = np.minimum(touched + 1, len(symbols) - 1)
            same = (right > touched) & (word[touched] == word[right])
            found, piece = self._lookup(symbols[touched], symbols[right])
            rank[touched], whole[touched] = np.where(same, found, _NONE), piece
        if not done_symbols:
            return symbols, word
        words = np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_symbols)[order], words[order]

    def _by_heap(self, symbols: list[int]) -> list[int]:
        """The same merges for one long word."""
        n, pairs = len(symbols), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                found = pairs.get(symbols[a] << 32 | symbols[b]) if min(
                    symbols[a], symbols[b]) >= 0 else None
                if found:
                    heapq.heappush(heap, (found[0], a, symbols[a], symbols[b], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, left, right, whole = heapq.heappop(heap)
            b = after[a] if alive[a] else n
            if b >= n or symbols[a] != left or symbols[b] != right:
                continue
            symbols[a], alive[b] = whole, False
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s, good in zip(symbols, alive) if good]

    def _ids(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of merged symbols: those that are no piece become bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.spare))
        if not len(odd):
            return symbols, word
        spelt = []
        for s in symbols[odd].tolist():
            letter = chr(-s - 1) if s < 0 else self.spare_letters[s - self.spare]
            spelt.append(self.bytes[np.frombuffer(letter.encode(), np.uint8)])
        counts = np.ones(len(symbols), np.int64)
        counts[odd] = [len(s) for s in spelt]
        out = np.repeat(symbols, counts)
        out[np.repeat(np.isin(np.arange(len(symbols)), odd), counts)] = np.concatenate(spelt)
        return out, np.repeat(word, counts)

    def words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word (a text without spaces behind other
        characters)."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        seen, place = np.unique(points, return_inverse=True)
        letters = self.letters
        symbols = np.array([letters.get(c, -c - 1) for c in seen.tolist()], np.int64)[place] \
            if len(seen) else points
        lengths = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        # segments: words cut further where no piece holds both neighbours
        cut = np.ones(len(points), bool)
        if len(points):
            both = points[:-1] << 32 | points[1:]
            at = np.searchsorted(self.inside, both)
            at[at == len(self.inside)] = 0
            cut[1:] = (self.inside[at] != both) | (word[1:] != word[:-1])
        segment = np.cumsum(cut) - 1
        sizes = np.bincount(segment) if len(segment) else np.zeros(0, np.int64)
        long = sizes[segment] > LONG_WORD if len(segment) else cut
        kept, of = self.rounds(symbols[~long], segment[~long])
        if long.any():
            ends = np.cumsum(sizes)
            merged = [(s, self._by_heap(symbols[ends[s] - sizes[s]:ends[s]].tolist()))
                      for s in np.flatnonzero(sizes > LONG_WORD).tolist()]
            kept = np.concatenate([kept, *[np.array(m, np.int64) for _, m in merged]])
            of = np.concatenate([of, np.repeat([s for s, _ in merged],
                                               [len(m) for _, m in merged])])
            order = np.argsort(of, kind="stable")
            kept, of = kept[order], of[order]
        if not len(kept):
            return [b""] * len(words)
        kept, of = self._ids(kept, word[np.flatnonzero(cut)][of])
        data = kept.astype("<u4").tobytes()
        ends = (4 * np.searchsorted(of, np.arange(len(words) + 1))).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def split(self, text: str) -> list[str]:
        """The words of a text, spaces shown as in pieces."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return _WORD.findall(SPACE + text if self.dummy_prefix else text)

    def encode_batch(self, texts: list[str], memory: "_Memory | None" = None
                     ) -> list[np.ndarray]:
        """Ids of whole texts; ``memory`` keeps the ids of words between calls."""
        memory = _Memory() if memory is None else memory
        # as in split, but a space is one byte
        lead = " " if self.dummy_prefix else ""
        parts = [(lead + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
        data = b"".join(parts)
        if not data:
            return [np.zeros(0, np.int64) for _ in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        space = np.frombuffer(data, np.uint8) == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(start)
        words, place = distinct(data, starts)
        ids = memory.find(words)
        new = [i for i, x in enumerate(ids) if x is None]
        found = self.words([words[i].decode().replace(" ", SPACE) for i in new])
        memory.update(zip([words[i] for i in new], found))
        for i, x in zip(new, found):
            ids[i] = x
        blob, at = offset_table(ids)
        flat = np.frombuffer(joined(blob.view("<u4"), at // 4, place), "<u4").astype(np.int64)
        upto = np.cumsum(np.append(0, np.diff(at)[place] // 4))
        return np.split(flat, upto[np.searchsorted(starts, ends)][:-1])

    # -- decoding ---------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of a list of ids, as the library decodes it."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.kinds)):
            raise ValueError("an id outside the vocabulary")
        if self.plain[ids].all():
            data = joined(*self.strings, ids)
            first = len(ids) and self.kinds[ids[0]] == _NORMAL and data[:1] == b" "
            try:
                return data[1 if first and self.dummy_prefix else 0:].decode()
            except UnicodeDecodeError:
                pass
        blob, starts = self.strings
        out, run, open_start = [], bytearray(), True  # a first space is taken off once
        for i in ids.tolist():
            data = blob[starts[i]:starts[i + 1]].tobytes()
            kind = self.kinds[i]
            if kind == _BYTE:
                run += data
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if kind == _NORMAL:
                text = data.decode()
                if open_start and not any(out) and self.dummy_prefix and text[:1] == " ":
                    text, open_start = text[1:], False
                else:
                    open_start = open_start and not text
                out.append(text)
            else:
                out.append(data.decode())
        return "".join(out) + _utf8(bytes(run))

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return joined(*self.numbers, ids)[:-1]


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def load(path: str) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


class _Memory(dict):
    """Words of one worker and their ids, the older generation beside the younger."""

    def __init__(self):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the younger generation

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word, None for new ones; what is met again becomes younger."""
        found = list(map(self.get, words))
        again = [i for i, x in enumerate(found) if x is None and words[i] in self.older]
        for i in again:
            found[i] = self.older[words[i]]
        self.update([(words[i], found[i]) for i in again])
        return found

    def update(self, new) -> None:
        for word, ids in new:
            self[word] = ids
            self.held += 200 + len(word) + len(ids)

    def trim(self) -> None:
        if self.held > REMEMBERED_BYTES // 2:
            self.older = self.copy()
            self.clear()
            self.held = 0


def _encoded(pieces: Pieces, batches: Iterator[pa.RecordBatch]
             ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches, and the ids of their last column's texts."""
    memory = pieces.memory
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        rows = max(1, int(len(batch) * SLICE_BYTES / max(texts.nbytes, 1)))
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            yield part, pieces.encode_batch([t.as_py() or "" for t in texts.slice(at, rows)],
                                            memory)
            memory.trim()


def encoded(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the ids (array of int) of every whole text, without begin or end
    ids; a null text counts as empty and has no ids."""
    return _mapped(df, text_col, ids_col, "array<int>", path)


def decoded(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of every list of ids; a null list counts as empty
    and decodes to an empty text, an id outside the vocabulary is an error."""
    return _mapped(df, ids_col, text_col, "string", path)


def _mapped(df: DataFrame, column: str, name: str, kind: str, path: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(load(path))
    own = [c for c in df.columns if c != name]  # by place, so that no name can clash
    source = df.select(*[ref(c).alias(f"c{i}") for i, c in enumerate(own)],
                       ref(column).alias("source"))
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(source.schema.fields[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        names = [*[f"c{i}" for i in range(len(fields))], "made"]
        if kind == "string":
            for batch in batches:
                texts = [pieces.decode(x.as_py() or []) for x in batch.column(len(fields))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(texts, pa.string())], names=names)
            return
        for part, ids in _encoded(pieces, batches):
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=names)

    made = source.mapInArrow(run, ", ".join([*fields, f"made {kind}"]))
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)],
                       F.col("made").alias(name))


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text: it is
    encoded, and its ids are decoded again, inside one batch.

    A null or empty text has no ids; its digests are those of empty strings.  A text of
    any length is read whole.  Repeated rows give repeated results, null ids stay null,
    an empty table gives none; other columns play no part, whatever their names.
    """
    shared = df.sparkSession.sparkContext.broadcast(load(path))
    source = df.select(ref(id_col).alias("doc_id"), ref(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for part, found in _encoded(pieces, batches):
            numbers = [hashlib.sha256(pieces.decimals(ids)).hexdigest() for ids in found]
            texts = [hashlib.sha256(pieces.decode(ids).encode()).hexdigest() for ids in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(list(map(len, found)), pa.int64()),
                 pa.array(numbers, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
