"""Token counts of the compiled transducer against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from burstline.llm import queries, transducer
from burstline.llm.textbytes import flat

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.read_pieces(PATH))


def counted(machine, texts):
    return machine.count(*flat(pa.array(texts, pa.string()))).tolist()


def test_odd_strings(machine, library):
    rng = random.Random(0)
    parts = [" ", "  ", "   ", "\n", "\t", "\0", "▁", "▁▁", "the", "ing", "ation", "e", "t", "12", "9", "--", "==", "é",
             "ß", "中", "文字", "😀", "क", "ि", "<s>", "</s>", "<unk>", "<0x0A>", "|", "'", "​", "�"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(4000)]
    assert counted(machine, texts) == library(texts)


@pytest.mark.parametrize("kind", ["pieces", "characters"])
def test_strings_of_the_vocabulary(machine, library, kind):
    rng = random.Random(1)
    pool = [p for p in machine.score if kind == "pieces" or len(p) == 1]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(2000)]
    assert counted(machine, texts) == library(texts)


def test_chunks_of_long_stretches_are_composed(machine, library):
    rng = random.Random(2)
    texts = [c * n for c in ("a", " ", "=", "ab", "the") for n in (63, 64, 65, 129, 1000, 5003)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (65, 128, 700, 30_000)]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(60, 400))) for _ in range(200)]
    assert counted(machine, texts) == library(texts)


def test_two_million_characters_without_a_place_to_start_anew(machine, library):
    texts = ["x" + "aab" * 700_000, " " * 1_000_001]
    assert counted(machine, texts) == library(texts)


def test_a_forgetful_machine_counts_alike(library, monkeypatch):
    monkeypatch.setattr(transducer, "MOST_STATES", 10)
    small = transducer.Transducer(transducer.read_pieces(PATH))
    texts = ["some ordinary words", "", "and others besides", "ordinary", "ünüsual wörds"]
    for text in texts * 2:
        assert counted(small, [text]) == library([text])


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "no.model"
    path.write_bytes(b"")
    with pytest.raises(ValueError, match="no plain BPE model"):
        transducer.read_pieces(str(path))


def test_edges(spark, library):
    schema = "doc_id long, text string, n_bytes string, `_text_of_row` int"
    rows = [(1, None, "x", 1), (1, "", "x", 1), (None, "two words", "x", 2), (None, "two words", "x", 2),
            (3, "é\0", None, None)]
    got = transducer.token_counts(spark.createDataFrame(rows, schema), PATH, limit=1)
    found = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect())
    two, odd = library(["two words", "é\0"])
    assert found == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (0, 9, two, True), (0, 9, two, True), (3, 3, odd, odd > 1)]
    )
    assert transducer.token_counts(spark.createDataFrame([], schema), PATH).count() == 0
    kept = transducer.token_counts(spark.createDataFrame(rows, schema), PATH, keep=("text", "doc_id"))
    assert kept.columns == ["text", "doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11_transducer(spark, SF).collect()}
    assert got.keys() == docs.keys()
    want = dict(zip(docs, library(list(docs.values()))))
    for doc, text in docs.items():
        assert got[doc].n_tokens == want[doc] and got[doc].n_bytes == len(text.encode())
        assert got[doc].over_limit == (want[doc] > 4096)
    assert np.sum([r.n_tokens for r in got.values()]) > 0
