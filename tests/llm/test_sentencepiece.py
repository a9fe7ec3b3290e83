import numpy as np
from sentencepiece import SentencePieceProcessor

from cohortry.llm import sentencepiece as sp
from cohortry.llm.common import table
from cohortry.llm.queries import op8_sentencepiece, tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
TEXTS = ["", " ", "a", " two  spaces ", "Élan vital ß", "emoji 🙂🙃 end", "line\nfeed\ttab", "x" * 300, "　 wide", "<s> </s> <0x41>", "   ", "\0", "日本語のテキスト", "the theory of the other"]


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def unigram_model(pieces):
    """A model file of kind unigram with the same pieces and scores: pieces, byte fallback on, identity normaliser."""
    out = b""
    for i, (name, score) in enumerate(zip(pieces.names, pieces.scores, strict=True)):
        kind = 6 if pieces.is_byte[i] else 1 if pieces.is_normal[i] else 2 if i == 0 else 3
        out += field(1, field(1, name.encode()) + varint(2 << 3 | 5) + np.float32(score).tobytes() + varint(3 << 3) + varint(kind))
    out += field(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1))
    return out + field(3, field(1, b"identity") + varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0) + varint(5 << 3) + varint(1))


def test_the_model_file_tells_its_type():
    with open(PATH, "rb") as file:
        assert not sp.is_unigram(file.read())
    assert sp.is_unigram(unigram_model(sp.from_scores(["<unk>", "a"], [0.0, -1.0]))) and sp.is_unigram(b"")


def test_ids_equal_the_library_on_the_same_unigram_model(spark):
    pieces = sp.from_file(PATH)
    pieces = sp.Pieces(pieces.names, pieces.scores.astype(np.float32).astype(float), pieces.is_byte, pieces.is_normal)
    library = SentencePieceProcessor(model_proto=unigram_model(pieces))
    own = sp.Encoder(pieces)
    texts = TEXTS + [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    for text, (raw, score, n) in zip(texts, own.encode(texts), strict=True):
        ids, want = np.frombuffer(raw, "<i4").tolist(), library.encode(text)
        assert len(ids) == n
        if ids != want:  # another path of the same score: single precision in the library
            assert np.isclose(score, sum(pieces.scores[i] if not pieces.is_byte[i] else 0 for i in want) + score_of_bytes(own, want), atol=0.05, rtol=1e-5)


def score_of_bytes(own, ids):
    raw = b"".join(own.raw[i] for i in ids if own.pieces.is_byte[i])
    return own.unknown * len(raw.decode("utf-8", "ignore"))


def test_best_path_equals_brute_force():
    letters = [f"<0x{b:02X}>" for b in range(256)]
    names = ["<unk>", *letters, sp.MARK, "a", "b", "ab", "ba", sp.MARK + "a", "aba", sp.MARK + "ab", "bb"]
    rng = np.random.default_rng(6)
    pieces = sp.from_scores(names, [0.0] * 257 + (-rng.random(9) * 5).tolist())
    own = sp.Encoder(pieces)
    known = {n: s for n, s, k in zip(names, pieces.scores, pieces.is_normal, strict=True) if k}

    def brute(text):
        if not text:
            return 0.0
        ends = [known[text[:k]] + brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in known]
        return max(ends + ([own.unknown + brute(text[1:])] if text[0] not in known else []))

    for _ in range(200):
        text = "".join(rng.choice(list("ab c"), rng.integers(1, 9)))
        assert np.isclose(own.encode([text])[0][1], brute(sp.MARK + text.replace(" ", sp.MARK)))


def test_trie_holds_exactly_its_keys():
    rng = np.random.default_rng(8)
    keys = sorted({bytes(rng.integers(0, 256, rng.integers(1, 6)).astype(np.uint8)) for _ in range(3000)})
    trie = sp.Trie(keys, list(range(len(keys))))
    for probe in keys + [k + b"\x07" for k in keys[:500]]:
        state = np.zeros(1, np.int64)
        for c in probe:
            state = trie.step(state, np.array([c])) if state[0] >= 0 else state
        assert (trie.value[state[0]] if state[0] >= 0 else -1) == (keys.index(probe) if probe in keys else -1)


def test_round_trip_of_every_document_and_awkward_rows(spark):
    assert op8_sentencepiece(spark, "/root/testdata/sf0.01").where("not round_trip").count() == 0
    docs = spark.createDataFrame([(1, None, 1), (None, "", 1), (2, "é▁x", 1), (2, "é▁x", 1), (3, "long " * 40000, 1)], "doc_id long, text string, score int")
    out = sp.encode(docs, PATH).collect()
    assert [(r.doc_id, r.decoded) for r in out[:4]] == [(1, ""), (None, ""), (2, "é x"), (2, "é x")] and out[4].decoded == "long " * 40000
    assert sp.encode(docs.limit(0), PATH).count() == 0 and sp.digests(docs, PATH).where("round_trip").count() == 5
