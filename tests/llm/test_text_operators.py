import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from tests.llm.helpers import LOWER, WORD, empty, odd_documents, prose
from tidylake.llm import bpe, quality, token_output
from tidylake.llm.common import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def test_quality_base_counts_match_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice(["a", "b", "c|", "dé", "#", "e"]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", "\n", "\t", "  ", "\n\n", " "]) for w in words)
        assert quality.base_counts(text) == brute_base(text)
    many = " ".join(str(i % 7000) for i in range(15000))  # ranks are renewed on long texts
    assert quality.base_counts(many) == brute_base(many)


def test_quality_bands():
    pack = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(20_000))
    # distinct random letters compress like prose; bytes do not compress at all
    assert quality.compression(noise, pack)[-1] == "incompressible"
    assert quality.compression(b"buy now " * 2000, pack)[-1] == "repetitive"
    letters = "".join(rng.choice("etaoinshrdlu     ") for _ in range(9000)).encode()
    assert quality.compression(letters, pack)[-1] == "prose"
    half = letters[:6000] + b"spam " * 1600  # the whole passes, its chunks do not
    assert quality.compression(half, pack)[-1] == "repetitive"


def test_quality_odd_rows(spark):
    df = odd_documents(spark)
    got = quality.compression_bands(df).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"], r["base_failed"]) == brute_base(r["text"])
        assert not (r["kept"] and r["base_failed"])
    assert {r["a.b"] for r in got} == {"clash"}
    assert quality.compression_bands(empty(spark, df.schema)).count() == 0


def test_quality_limits_come_from_the_table(spark):
    """Texts that repeat a little more, or less, than the table's prose of their
    length are rejected; a family of copies does not set the limits."""
    rng = random.Random(11)

    def text(words, n, lead):
        return f"{lead} " + " ".join(rng.choice(words) for _ in range(n))

    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 9))) for _ in range(900)]
    rows = [("prose", text(words, rng.randrange(200, 500), i)) for i in range(150)]
    rows += [("repeats", text(words[:110], 350, i)) for i in range(8)]
    rows += [("noise", " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789")
                                        for _ in range(7)) for _ in range(300))) for i in range(8)]
    copy = text(words[:300], 350, "copy " * 2 + " ".join(words[:12]))
    rows += [("copy", f"{copy} {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "kind string, text string")
    pack = zstandard.ZstdCompressor(level=3).compress
    fixed = {(k, quality.compression(t.encode(), pack)[-1]) for k, t in rows}
    got = quality.compression_bands(df).where("not base_failed").collect()
    kinds = {k: [r["verdict"] for r in got if r["kind"] == k] for k in ("prose", "repeats", "noise")}
    assert ("repeats", "prose") in fixed and ("noise", "prose") in fixed
    assert set(kinds["repeats"]) == {"repetitive"} and set(kinds["noise"]) == {"incompressible"}
    assert kinds["prose"].count("prose") >= 0.97 * len(kinds["prose"]) > 0


@pytest.fixture(scope="module")
def codec():
    return bpe.load(WORDS).prepare()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def test_bpe_equals_the_library(codec, library):
    rng = random.Random(7)
    makers = [
        lambda: "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0, 0xD800),
                                        rng.randrange(0xE000, 0x1FFFF)])) for _ in range(30)),
        lambda: "".join(rng.choice("abcdeéèo'stredvlm 123 \n\t\x1c\x1f\x85\xa0İΣςß") for _ in range(60)),
        lambda: " ".join(rng.choice(["hello", "<|endoftext|>", "<|startoftext|>x", "world's",
                                     "can't", "ét", "́", "½"]) for _ in range(12)),
        lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 200))),
        lambda: rng.choice("aehlo!-=") * rng.randrange(1, 300)]
    for i in range(1500):
        text = makers[i % len(makers)]()
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(np.array(ids, np.int64)).decode() == library.decode(
            ids, skip_special_tokens=False)
        assert codec.decimals(np.array(ids, np.int64)).decode() == " ".join(map(str, ids))


def test_bpe_pairs_agree_with_merges(codec):
    """The compatibility rule against plain merging of two tokens' joint text."""
    rng = random.Random(5)
    tokens = [i for t, i in codec.units.items() if not ord(t[-1]) & 0x1000]
    names = {i: t for t, i in codec.units.items()}
    for _ in range(400):
        a, b = rng.choice(tokens), rng.choice(tokens)
        if not (codec._self_made(a) and codec._self_made(b)):
            continue
        parts = [codec.units[c] for c in names[a] + names[b]]
        while True:
            ranked = [(codec.merge[x << 32 | y][0], i) for i, (x, y) in enumerate(zip(parts, parts[1:]))
                      if x << 32 | y in codec.merge]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i:i + 2] = [codec.merge[parts[i] << 32 | parts[i + 1]][1]]
        assert codec._compatible(a, b) == (parts == [a, b])


def test_bpe_remembers_what_it_meets_again(monkeypatch, library):
    """A full memory drops what was not met again, and stays within its bytes."""
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 40_000)
    codec, asked, rng = bpe.load(WORDS).prepare(), [], random.Random(3)
    encode_word = codec.word
    monkeypatch.setattr(codec, "word", lambda units: asked.append(units) or encode_word(units))
    for _ in range(200):
        made = ["".join(rng.choice("abcdeé") for _ in range(9)) for _ in range(10)]
        text = " ".join(["hello", "Hello,", "éternels", "world's<|endoftext|>", *made])
        assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        held = [m for name, m in vars(codec).items() if name.endswith(("words", "chunks"))]
        assert sum(170 + 2 * len(t) + len(ids) for m in held for t, ids in m.items()) < 41_000
    assert len(asked) > 1500 and len(asked) - len(set(asked)) <= 5


def test_bpe_odd_rows(spark, library):
    df = odd_documents(spark)
    got = bpe.digests(df, WORDS).collect()
    want = []
    for r in df.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    both = bpe.decoded(bpe.encoded(df, WORDS), WORDS)
    assert both.columns == [c for c in df.columns if c != "ids"] + ["ids", "decoded"]
    for r in both.collect():
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
    assert bpe.digests(empty(spark, df.schema), WORDS).count() == 0


def test_chunked_encoder_equals_the_library():
    with open(BYTES, encoding="utf-8") as f:
        spec = f.read()
    encoder, library = token_output.Encoder(spec, 2).prepare(), Tokenizer.from_str(spec)
    rng = random.Random(5)
    parts = ["a", "b", "é", "ł", " ", "  ", "\n", "\n\n", "'", "'s", "'t", "'ll", ".", "1", "23", "²",
             "½", "µ", "ª", "\xa0", "\x85", "中", "<|endoftext|>", "_", "-", "don't", "Hello", "\x1c",
             "ɏ", "ɐ", "·", "×", "÷"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 16))) for _ in range(4000)]
    for text, data in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(data, "<u4").tolist() == want, text


def test_token_files(spark):
    df = odd_documents(spark).drop("first").withColumnRenamed("c0", "first")
    out = scratch_path(spark, "test-tokens")
    token_output.write_tokens(df, out, BYTES, 2)
    rows = token_output.read_tokens(spark, out)
    got = token_output.placed(token_output.id_crc32(rows), out).orderBy("start").collect()
    library = Tokenizer.from_file(BYTES)
    texts = {}
    for r in df.collect():
        texts.setdefault(r["doc_id"], []).append(library.encode(
            r["text"] or "", add_special_tokens=False).ids + [2])
    place, ids = 0, []
    for r in got:
        assert r["start"] == place
        place += r["n_tokens"]
        ids.append(-1 if r["doc_id"] is None else r["doc_id"])
        crcs = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in texts[r["doc_id"]]]
        assert r["ids_crc32"] in crcs
    assert ids == sorted(ids) and len(ids) == df.count()
    # encodings, and both page indexes, as set
    import glob

    import pyarrow.parquet as pq
    largest = max(glob.glob(out.removeprefix("file://") + "/*.parquet"), key=lambda p: pq.ParquetFile(p).metadata.num_rows)
    group = pq.ParquetFile(largest).metadata.row_group(0)
    column = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in column["ids.list.element"].encodings)
    assert column["ids.list.element"].has_offset_index and column["doc_id"].has_column_index
    none = scratch_path(spark, "test-tokens")
    token_output.write_tokens(empty(spark, df.schema), none, BYTES, 2)
    assert token_output.read_tokens(spark, none).count() == 0


def test_only_asked_columns_are_read(spark):
    out = scratch_path(spark, "test-tokens")
    token_output.write_tokens(spark.createDataFrame([(1, prose(30))], "doc_id long, text string"),
                              out, BYTES, 2)
    plan = token_output.read_tokens(spark, out, ("doc_id", "n_tokens"))._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_lower_is_ascii_only():
    assert "ÀB".translate(LOWER) == "Àb"


def test_files_are_in_the_order_of_their_parts(spark):
    from pyspark.sql import functions as F
    names = [f"part-{i:05d}-x.c000.zstd.parquet" for i in (0, 99_998, 99_999, 100_000, 100_001, 1_000_000)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "file string, place int")
    got = df.orderBy(token_output.part_number(F.col("file"))).select("place").collect()
    assert [r.place for r in got] == list(range(6)) and sorted(names) != names


def test_remembered_chunks_are_bounded_by_bytes(monkeypatch):
    with open(BYTES, encoding="utf-8") as f:
        encoder = token_output.Encoder(f.read(), 2).prepare()
    texts = [prose(80, i) for i in range(30)]
    want = encoder.encode(texts)
    monkeypatch.setattr(token_output, "REMEMBERED_BYTES", 3000)
    for text, ids in zip(texts, want):
        assert encoder.encode([text]) == [ids]
        assert encoder.held <= 3000 + 300 * len(text.split()) and (encoder.held > 0) == bool(encoder.known)


def test_chunks_are_told_apart_by_their_text():
    # a polynomial modulo 2**64 has one value for both of these runs, whatever its base
    with open(BYTES, encoding="utf-8") as f:
        spec = f.read()
    texts = ["".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(1 << 12)) for flip in (0, 1)]
    library = Tokenizer.from_str(spec)
    got = token_output.Encoder(spec, 2).prepare().encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [
        library.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_a_full_memory_keeps_chunks_met_again(monkeypatch):
    with open(BYTES, encoding="utf-8") as f:
        encoder = token_output.Encoder(f.read(), 2).prepare()
    asked = []
    words, library = encoder._words, encoder._library
    monkeypatch.setattr(encoder, "_words", lambda new: asked.extend(new) or words(new))
    monkeypatch.setattr(encoder, "_library", lambda new: asked.extend(new) or library(new))
    monkeypatch.setattr(token_output, "REMEMBERED_BYTES", 3000)
    wants = [encoder.encode([f" often éa new{chr(97 + i)}"]) for i in range(26)]
    assert asked.count(" often") == 1 and asked.count(" newa") == 1
    assert encoder.encode([" often éa newa"]) == wants[0] and asked.count(" newa") == 2
    assert asked.count(" often") == 1
