import re
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from cohortry.llm import token_store as ts
from cohortry.llm.common import table
from cohortry.llm.queries import op6_token_store, tokenizer_file

SF = "/root/testdata/sf0.001"
PATH = tokenizer_file("byte_bpe_50k.json")


def whole_ids(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_query_matches_encoding_of_whole_texts(spark):
    docs = sorted((r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect())
    want, start = {}, 0
    for (key, _), ids in zip(docs, whole_ids([t for _, t in docs]), strict=True):
        ids = [*ids, 0]
        want[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op6_token_store(spark, SF).collect()} == want


def test_chunks_leave_ids_as_they_are():
    ends = ["y", " y\n z", "\n", "'s 're 9\n9", "<|endoftext|>", "　q", "a  b", "", "é\nß 12,3", "\x85x", "\0 \0\nx"]
    texts = [a + b + c for a in ("", "\n", " ", " x", "don't", " x ", "a\tb", "  ", "\0") for b in ends for c in ends]
    rng = np.random.default_rng(3)
    texts += ["".join(rng.choice(list("aé.,'1 \n\t\u3000\x85\x1c-"), rng.integers(1, 12))) for _ in range(20000)]
    with open(PATH, encoding="utf-8") as file:
        got = ts.ChunkEncoder(file.read(), np.uint16).encode(texts)
    assert whole_ids(["a <|endoftext|> b"]) == [[64, 220, 50256, 275]]
    assert [np.frombuffer(g, np.uint16).tolist() for g in got] == whole_ids(texts)


def test_a_word_is_encoded_once_whatever_marks_follow():
    class Counted:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, name):
            self.asked.append(name)
            return self.model.tokenize(name)

    with open(PATH, encoding="utf-8") as file:
        encoder = ts.ChunkEncoder(file.read(), np.uint16)
    encoder.model = Counted(encoder.model)
    texts = ["zebra zebra, zebra. (zebra) zebra?!", "zebra: zebra; zebra"] * 50
    assert [np.frombuffer(g, np.uint16).tolist() for g in encoder.encode(texts)] == whole_ids(texts)
    assert len(encoder.model.asked) == 2  # at the start of a text and after a space


def test_columns_are_encoded_as_their_whole_texts():
    with open(PATH, encoding="utf-8") as file:
        encoder = ts.ChunkEncoder(file.read(), np.uint16)
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace() and c not in (10, 32)]
    texts = ["", "one", "a  b", "two words\nand more", *(f"x{c}y z" for c in blanks), "", "é ß, ü", " lead", "end\n", "<|endoftext|> b"]
    assert [m.as_py() for m in ts.pc.match_substring_regex(pa.array([f"x{c}y" for c in blanks]), ts.WHOLE)] == [True] * len(blanks)
    for column in (pa.array(["skipped", *texts])[1:], pa.array(texts, pa.large_string()), pa.array(["a  b", " "]), pa.array([], pa.string())):
        assert [np.frombuffer(g, np.uint16).tolist() for g in encoder.encode_column(column)] == whole_ids(column.to_pylist())


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 5000):
        keys = rng.choice(10**12, n, replace=False) - 5 * 10**11
        pilots, slots = ts.build_index(keys)
        assert sorted(slots) == list(range(n)) and len(pilots) == n // ts.BUCKET_KEYS + 1


def test_lookup_finds_stored_keys_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "SHARD_IDS", 50)
    rows = [(k, text, "x") for k, text in [(-5, None), (0, ""), (7, "one two"), (9, "word " * 3000), (2**40, "é")]]
    ts.write(spark.createDataFrame(rows, "doc_id long, text string, shard string"), f"{tmp_path}/s", ts.byte_bpe(PATH), 50_257, parts=3)
    store = ts.open_store(spark, f"{tmp_path}/s")
    asked = spark.createDataFrame([(7,), (7,), (8,), (None,), (-5,), (9,), (2**40,)], "doc_id long")
    found = ts.lookup(store, asked)
    got = {r.doc_id: r.ids for r in found.collect()}
    assert found.count() == len(got)
    starts = {r.doc_id: r.start for r in ts.read_all(store).collect()}
    assert all(r.start == starts[r.doc_id] for r in found.collect())
    want = dict(zip([-5, 7, 9, 2**40], whole_ids(["", "one two", "word " * 3000, "é"]), strict=True))
    assert got == {k: [*v, 0] for k, v in want.items()}
    assert sorted(map(tuple, ts.lookup(store, asked, at_once=1).collect())) == sorted(map(tuple, found.collect()))


def test_lookup_reads_only_the_parts_it_needs_and_moves_no_payload(spark, tmp_path):
    rows = [(k, f"text {k}") for k in range(400)]
    ts.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/s", ts.byte_bpe(PATH), 50_257, parts=8)
    found = ts.lookup(ts.open_store(spark, f"{tmp_path}/s"), spark.createDataFrame([(3,), (5,)], "doc_id long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan)
    assert {r.doc_id for r in found.collect()} == {3, 5}


def test_empty_table_and_repeated_keys(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    ts.write(none, f"{tmp_path}/none", ts.byte_bpe(PATH), 50_257)
    assert ts.read_all(ts.open_store(spark, f"{tmp_path}/none")).count() == 0
    rows = [(1, "b"), (1, "a"), (None, "x"), (None, None), (2, "a"), (2, "a")]
    ts.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/twice", ts.byte_bpe(PATH), 50_257, parts=2)
    store = ts.open_store(spark, f"{tmp_path}/twice")
    read = sorted((r.start, r.doc_id, r.n_tokens) for r in ts.read_all(store).collect())
    assert [(d, n) for _, d, n in read] in ([(None, 1), (None, 2), (1, 2), (1, 2), (2, 2), (2, 2)], [(None, 2), (None, 1), (1, 2), (1, 2), (2, 2), (2, 2)])
    a, b = whole_ids(["a"])[0][0], whole_ids(["b"])[0][0]
    assert sorted(r.ids for r in ts.lookup(store, spark.createDataFrame([(1,)], "doc_id long")).collect()) == sorted([[a, 0], [b, 0]])


def test_a_crowded_key_fills_many_shards_and_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "SHARD_IDS", 40)
    rows = [(5, f"copy number {i}") for i in range(300)] + [(None, f"no key {i}") for i in range(300)] + [(k, "single") for k in range(10, 40)]
    ts.write(spark.createDataFrame(rows, "doc_id long, text string"), f"{tmp_path}/hot", ts.byte_bpe(PATH), 50_257, parts=6)
    store = ts.open_store(spark, f"{tmp_path}/hot")
    assert len(store.parts) > 3 and store.shards.count() > 20
    got = ts.lookup(store, spark.createDataFrame([(5,), (12,)], "doc_id long")).collect()
    want = [[*ids, 0] for ids in whole_ids([t for k, t in rows if k in (5, 12)])]
    assert sorted(r.ids for r in got) == sorted(want)
    assert ts.read_all(store).groupBy("doc_id").count().count() == 32
