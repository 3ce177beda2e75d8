import random
import zlib

import numpy as np
import pytest

from keelstone.llm import id_files, jvm

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, start string, ids_crc32 string"


@pytest.mark.parametrize("n", [1, 5, 4096, 4097, 30_000])
def test_round_trip_of_blocks(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50_257, n), rng.zipf(1.3, n) % 50_257, np.full(n, 50_256), np.tile([7, 8, 9], n)[:n], np.arange(n) % 50_257):
        blocks, sums = id_files.pack(ids)
        assert (id_files.unpack(blocks, n, sums) == ids).all()
    assert len(b"".join(id_files.pack(np.tile([7, 8, 9], n)[:n])[0])) < n / 3 + 64 * -(-n // 4096)


def test_damage_is_seen():
    blocks, sums = id_files.pack(np.arange(5000))
    with pytest.raises(ValueError):
        id_files.unpack([blocks[0][:50] + b"\x00\xff" + blocks[0][52:], blocks[1]], 5000, sums)
    assert id_files.pack(np.zeros(0, int)) == ([], []) and len(id_files.unpack([], 0, [])) == 0


def test_files(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    odd = ["two  spaces\n\n next", "tab\t x \x1c y", " lead", "it's 3'd é ü漢字 🎉 _x", "<|endoftext|> a<|endoftext|>", "  nb   em", "trail  ", "x" * 3000, ""]
    rows = [(i, rng.choice(odd) + " ".join(rng.choice(["the", "of", "Wörd", "12", "!!"]) for _ in range(rng.randint(0, 60))), "", "") for i in rng.sample(range(1000), 200)]
    rows += [(2000 + i, t, "", "") for i, t in enumerate(odd)] + [(5000, None, "", ""), rows[3], (None, "none", "", "")]
    rows += [(6000, "long " * 40_000, "", "")]
    got = id_files.stored(spark.createDataFrame(rows, SCHEMA).repartition(5), path).collect()
    start = 0
    want = []
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] if r[0] is not None else -1, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    id_files.write(spark.createDataFrame(rows, SCHEMA), path, str(tmp_path / "f"))
    assert sum(len(r.ids) for r in id_files.read(spark, str(tmp_path / "f")).collect()) == start
    assert id_files.stored(spark.createDataFrame([], SCHEMA), path).collect() == []


def test_runs_are_numbered_in_one_pass(monkeypatch):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), id_files.Tokens(path)
    rng = random.Random(4)
    some = ["the", "  x", "it's", "Wörd,", "12", "漢字 b", "\n\n", "!?", "_a"]
    monkeypatch.setattr(id_files, "KEPT_RUNS", 60)
    for _ in range(12):  # runs of both kinds come up mixed, are known from texts before, and are forgotten
        texts = [" ".join(rng.choice([*some, f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(30))) for _ in range(8)]
        ids, counts = own.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids + [id_files.END] for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
        assert not own.number.fresh and len(own.number) <= len(own.starts)


def test_white_characters_before_a_word():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), id_files.Tokens(path)
    for t in ("a\n\nb", "\n\n1", "end.\n\n\nNext", " \t\tx", "\xa0\xa0x", "\n \x85é", "\n\n", "x\n\n y", "\n\n_"):
        assert own.encode([t])[0].tolist()[:-1] == library.encode(t, add_special_tokens=False).ids


def texts(n):
    rng = random.Random(n)
    some = ["the", "of", " ", "  x", "it's", "'s", "x' y", "don''t", "Wörd,", "é", "12", "_a", "a_b", "\n\n", "\t", "!?", " 'tis", "漢字 b", "🎉", "\x85", "\xa0", "ɏɐ", "<|endoftext|>", " жё", "—", "don’t", "\u2028", "a\u0301", " 漢", "'", "' "]
    out = ["", None, " ", "'", "a'", " 'a", "x" * 5000, "\u024f", "\u0250"]
    return out + [rng.choice(["", " "]).join(rng.choice([*some[: rng.choice([17, len(some)])], f" w{rng.randrange(300)}"]) for _ in range(rng.randrange(200))) for _ in range(n)]


def test_files_are_coded_in_the_jvm_as_in_numpy(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(id_files, "KEPT_RUNS", 150)
    monkeypatch.setattr(id_files, "FILE_IDS", 9000)
    rows = list(enumerate(texts(600)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    id_files.write(docs, path, str(tmp_path / "jvm"), parts=2)
    assert "Python" not in (plan := id_files._read(spark, str(tmp_path / "jvm"), True)._jdf.queryExecution().toString()) and "Arrow" not in plan
    files = sorted(spark.read.parquet(str(tmp_path / "jvm")).collect())
    assert len(files) > 4
    for f in files:
        ids = [library.encode(rows[i][1] or "", add_special_tokens=False).ids + [id_files.END] for i in f.doc_ids]
        assert f.counts == list(map(len, ids))
        blocks, sums = id_files.pack(np.concatenate(ids))
        assert list(map(bytes, f.blocks)) == blocks and f.sums == sums
    own = [id_files._read(spark, str(tmp_path / "jvm"), d).sort("doc_id").collect() for d in (True, False)]
    monkeypatch.setattr(jvm, "reachable", lambda spark: False)
    assert own == [id_files._read(spark, str(tmp_path / "jvm"), d).sort("doc_id").collect() for d in (True, False)]
    id_files.write(docs, path, str(tmp_path / "numpy"), parts=2)
    assert own[0] == id_files._read(spark, str(tmp_path / "numpy"), True).sort("doc_id").collect()


@pytest.mark.parametrize("n", [1, 4096, 4097, 30_000])
def test_blocks_in_the_jvm(spark, n):
    gateway, coder = spark.sparkContext._gateway, jvm.new(spark, "IdFiles", "Coder")
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 18, n), rng.zipf(1.3, n) % 50_257, np.full(n, 50_256), np.tile([7, 8, 9], n)[:n], np.arange(n) % 50_257):
        a = 0
        for block, size in zip(id_files.pack(ids)[0], id_files.block_sizes(n, -(-n // 4096)).tolist(), strict=True):
            got = gateway.new_array(gateway.jvm.int, size)
            coder.unpack(block, got, 0, size)
            assert list(got) == ids[a : a + size].tolist() and bytes(coder.pack(got, 0, size)) == block
            a += size


def test_damage_is_seen_in_the_jvm(spark, tmp_path):
    rng = random.Random(5)
    path, whole = P.path("byte_bpe_50k.json"), str(tmp_path / "f")
    id_files.write(spark.createDataFrame([(i, " ".join(f"w{rng.randrange(900)}" for _ in range(500))) for i in range(20)], "doc_id long, text string"), path, whole, parts=1)
    (f,) = spark.read.parquet(whole).collect()
    blocks = list(map(bytes, f.blocks))
    for k in range(6):
        cut = rng.randrange(len(blocks[0]))
        other = [blocks[1], blocks[0][:cut], blocks[0][:cut] + rng.randbytes(40), b"\xff" * len(blocks[0]), b"", None][k]
        bad = [other, *blocks[1:]] if other is not None else blocks[1:]
        spark.createDataFrame([(*f[:5], bad, f.sums)], id_files.SCHEMA).write.parquet(at := str(tmp_path / f"bad{k}"))
        with pytest.raises(Exception, match="is damaged|are missing"):
            id_files._read(spark, at, True).collect()
