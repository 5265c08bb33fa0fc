"""BPE encoding by backtracking, and decoding by an offset table.

A word's BPE encoding is the only way to split it into tokens such that each
neighbouring pair is compatible: encoding the two tokens' joint text gives just
these two.  So instead of applying merges one by one, the encoder takes the
longest token that starts at each position (found by one Aho-Corasick pass),
checks it against its left neighbour in a pair table, and backs off to the next
shorter token - or the previous position - where the pair is not compatible.  A
position that failed once is never tried again, so the work is linear.

Whether a pair is compatible follows from the merges alone: undo the merges next
to the border, latest first; if at some point the two border tokens had a merge
of their own that was due before the one just undone, BPE would have merged
across the border.

Decoding takes each id's bytes from one blob by an offset table.

The vocabulary is a file of the tokenizers library, given by its path; it is
read once on the driver and sent to the tasks (its size is that of the file).
Words are remembered per Python worker, up to a number of bytes, in two generations:
when the younger is full, the older goes, except for what was met again meanwhile.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from tidylake.llm.common import ref

#: Bytes of words, of chunks and of their ids that a worker remembers, and pairs.
REMEMBERED_BYTES = 128_000_000
REMEMBERED_PAIRS = 250_000
SLICE_BYTES = 4_000_000
_ENDED = 0x1000  # added to a word's last symbol


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: the byte's own character where printable, else the next unused
    one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = [""] * 256, 0x100
    for b in shown:
        symbols[b] = chr(b)
    for b in range(256):
        if not symbols[b]:
            symbols[b] = chr(spare)
            spare += 1
    return symbols


def joined(blob: np.ndarray, starts: np.ndarray, ids: np.ndarray, piece: int = 1 << 20) -> bytes:
    """The concatenated entries ``blob[starts[i]:starts[i + 1]]`` of ``ids``."""
    out = []
    for at in range(0, len(ids), piece):
        part = ids[at:at + piece]
        first = starts[part]
        length = starts[part + 1] - first
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(first - (ends - length), length)
        place += np.arange(total)
        out.append(blob[place].tobytes())
    return b"".join(out)


def offset_table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One blob of all entries, and where each begins."""
    starts = np.cumsum([0, *map(len, entries)])
    return np.frombuffer(b"".join(entries), np.uint8), starts


class Codec:
    """Encoder and decoder of one vocabulary file: BPE over byte symbols with an
    end-of-word suffix, its normaliser, split pattern and special tokens."""

    def __init__(self, text: str):
        self.text, self.library = text, None
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = next(p["pattern"]["Regex"] for p in pieces if p["type"] == "Split")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not self.suffix or spec["decoder"]:
            raise ValueError("a vocabulary with NFC, lower case, word ends and no decoder is needed")
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.rank = [-1] * size  # of the merge that makes a token; -1: a symbol
        self.merge: dict[int, tuple[int, int]] = {}  # pair -> rank, token
        for rank, (a, b) in enumerate(merges):
            whole = vocab[a + b]
            self.left[whole], self.right[whole], self.rank[whole] = vocab[a], vocab[b], rank
            self.merge[vocab[a] << 32 | vocab[b]] = rank, whole
        self.units = {self._units(t): i for t, i in vocab.items()}
        self.length = [0] * size
        for t, i in self.units.items():
            self.length[i] = len(t)
        strings = [b""] * size
        for t, i in [*vocab.items(), *self.specials.items()]:
            strings[i] = t.encode()
        self.strings = offset_table([s + b" " for s in strings])
        self.numbers = offset_table([b"%d " % i for i in range(size)])
        self._ready = False

    def _units(self, token: str) -> str:
        if not token.endswith(self.suffix):
            return token
        body = token[:-len(self.suffix)]
        return body[:-1] + chr(ord(body[-1]) + _ENDED) if body else token

    def __getstate__(self):
        return {**self.__dict__, "_ready": False, "automaton": None, "split": None,
                "special_split": None, "pairs": None, "words": None, "chunks": None,
                "older_words": None, "older_chunks": None, "library": None}

    def prepare(self) -> "Codec":
        """Build what is not sent: the automaton and the caches."""
        if self._ready:
            return self
        self.symbols = byte_symbols()
        self.split = regex.compile(self.pattern)
        self.special_split = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)))
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.older_chunks: dict[str, bytes] = {}
        self.held = 0  # bytes of the younger generation
        # tokens that BPE never makes of their own text are no candidates
        usable = {t: i for t, i in self.units.items() if self._self_made(i)}
        self.automaton = ahocorasick.Automaton()
        for t, i in usable.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * len(self.length)  # the next shorter token that begins alike
        for t, i in usable.items():
            for n in range(len(t) - 1, 0, -1):
                if (j := usable.get(t[:n])) is not None:
                    self.shorter[i] = j
                    break
        self._ready = True
        return self

    def _self_made(self, token: int) -> bool:
        """Whether BPE, given the token's text, arrives at the token."""
        a, b = self.left[token], self.right[token]
        return a < 0 or (self._self_made(a) and self._self_made(b)
                         and self._compatible(a, b, self.rank[token]))

    def _compatible(self, a: int, b: int, before: float = float("inf")) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before the
        merges inside them (and before rank ``before``)."""
        rank, merge = self.rank, self.merge
        while True:
            across = merge.get(a << 32 | b)
            if across is not None and across[0] < before:
                return False
            # undo the later one; of one rule, BPE merges the left place first
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                before, a = rank[a], self.right[a]
            else:
                before, b = rank[b] + 0.5, self.left[b]

    def word(self, units: str) -> list[int]:
        """Token ids of one word given as units."""
        n = len(units)
        longest = [0] * n
        length, shorter, pairs = self.length, self.shorter, self.pairs
        for end, token in self.automaton.iter(units):
            longest[end + 1 - length[token]] = token  # later ends are longer
        out: list[int] = []
        failed = bytearray(n + 1)
        at, last, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            good = not failed[end]
            if good and last >= 0:
                key = last << 32 | token
                good = pairs.get(key)
                if good is None:
                    if len(pairs) >= REMEMBERED_PAIRS:
                        pairs.clear()
                    good = pairs[key] = self._compatible(last, token)
            if good:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
                continue
            token = shorter[token]
            while token < 0:
                failed[at] = 1
                out.pop()
                at -= length[last]
                token = shorter[last]
                last = out[-1] if out else -1

    def _remember(self, text: str, ids: bytes, word: bool) -> None:
        """Keep the ids of a word or chunk; a full generation becomes the older one."""
        if len(text) >= 64:
            return
        (self.words if word else self.chunks)[text] = ids
        self.held += 170 + 2 * len(text) + len(ids)
        if self.held > REMEMBERED_BYTES // 2:
            self.older_chunks, self.chunks = self.chunks, {}
            self.older_words, self.words = self.words, {}
            self.held = 0

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run of text without white space."""
        ids = self.chunks.get(chunk)  # met since the text's first look
        if ids is not None:
            return ids
        ids = self.older_chunks.pop(chunk, None)
        if ids is None:
            if not self.special_split.search(chunk):
                words = self._split(chunk)
                if words == [chunk] and chunk.isascii():
                    return self._word(chunk)  # remembered there
                ids = b"".join([self._word(w) for w in words])
            else:
                parts, at = [], 0
                for m in self.special_split.finditer(chunk):
                    parts += [self._word(w) for w in self._split(chunk[at:m.start()])]
                    parts.append(self.specials[m.group()].to_bytes(4, "little"))
                    at = m.end()
                ids = b"".join(parts + [self._word(w) for w in self._split(chunk[at:])])
        self._remember(chunk, ids, False)
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a normalised word.  A word of ASCII is remembered with the chunks: as a
        chunk it is this one word."""
        plain = word.isascii()
        ids = (self.chunks if plain else self.words).get(word)
        if ids is None:
            ids = (self.older_chunks if plain else self.older_words).pop(word, None)
            if ids is None:
                symbols = self.symbols  # a letter of ASCII is its own
                units = word if plain and word.isalpha() else "".join(
                    [symbols[b] for b in word.encode("utf-8", "replace")])
                found = self.word(units[:-1] + chr(ord(units[-1]) + _ENDED))
                ids = struct.pack(f"<{len(found)}I", *found)
            self._remember(word, ids, not plain)
        return ids

    def _split(self, text: str) -> list[str]:
        """Normalised words of a run of text without white space."""
        if text.isascii():
            return [text.lower()] if text.isalpha() else self.split.findall(text.lower())
        if any(c >= "\u0530" and unicodedata.category(c) == "Cn" for c in text):
            # characters younger than Python's tables: the library knows their class
            if self.library is None:
                self.library = Tokenizer.from_str(self.text).normalizer, Split(
                    Regex(self.pattern), "removed", invert=True)
            normal, split = self.library
            return [w for w, _ in split.pre_tokenize_str(normal.normalize_str(text))]
        # lower case goes by single characters: no rule for a final sigma
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        # these four are white space for str.split alone
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            parts = regex.split(r"\s+", text)
        else:
            parts = text.split()
        out = list(map(self.chunks.get, parts))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._chunk(parts[i])
        return np.frombuffer(b"".join(out), "<u4").astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' strings joined by one space (a vocabulary without
        a decoder)."""
        return joined(*self.strings, ids)[:-1]

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by one space."""
        return joined(*self.numbers, ids)[:-1]


def load(path: str) -> Codec:
    with open(path, encoding="utf-8") as f:
        return Codec(f.read())


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE_BYTES``, at least one row each."""
    for batch in batches:
        rows = max(1, int(len(batch) * SLICE_BYTES / max(batch.nbytes, 1)))
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _mapped(df: DataFrame, column: str, name: str, kind: str, path: str, values) -> DataFrame:
    """``df`` with column ``name``: ``values(codec, pyarrow array)`` of ``column``."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))
    # by place, so that no name can clash
    own = [c for c in df.columns if c != name]
    source = df.select(*[ref(c).alias(f"c{i}") for i, c in enumerate(own)],
                       ref(column).alias("source"))
    kinds = [f.dataType.simpleString() for f in source.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.prepare()
        pa.default_memory_pool().release_unused()  # what earlier tasks of the worker left
        for batch in _batches(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], values(codec, batch.column(len(kinds)))],
                names=[*[f"c{i}" for i in range(len(kinds))], "made"])

    schema = ", ".join([*[f"c{i} {k}" for i, k in enumerate(kinds)], f"made {kind}"])
    made = source.mapInArrow(run, schema)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)],
                       F.col("made").alias(name))


def _encode(codec: Codec, texts: pa.Array) -> pa.Array:
    found = [codec.encode(t.as_py() or "").astype(np.int32) for t in texts]
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encoded(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids (array of int) of every whole text; a null text
    counts as empty and has no ids."""
    return _mapped(df, text_col, ids_col, "array<int>", path, _encode)


def decoded(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of every list of ids; a null list counts as
    empty and decodes to an empty text."""
    return _mapped(df, ids_col, text_col, "string", path, lambda codec, lists: pa.array(
        [codec.decode(np.array(x.as_py() or [], np.int64)).decode() for x in lists], pa.string()))


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text: it
    is encoded, and its ids are decoded again, inside one batch.

    A null or empty text has no tokens; its digests are those of empty strings.
    Repeated rows give repeated results, an empty table none; other columns play
    no part, whatever their names.
    """
    shared = df.sparkSession.sparkContext.broadcast(load(path))
    kind = dict(df.select(ref(id_col).alias("doc_id")).dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.prepare()
        for batch in batches:
            counts, numbers, strings = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids))
                numbers.append(hashlib.sha256(codec.decimals(ids)).hexdigest())
                strings.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(numbers, pa.string()),
                 pa.array(strings, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(ref(id_col).alias("doc_id"), ref(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
