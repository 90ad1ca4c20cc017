"""SentencePiece encoding, token counts and packing."""

import gc
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

P = pytest.importorskip("public_tokenizers")

from simmart.llm import packing, pieces, rollup  # noqa: E402
from simmart.llm.common import per_batch  # noqa: E402
from simmart.llm.queries import tokenizer_file  # noqa: E402

MODEL = tokenizer_file("piece_bpe_32k.model")
WORDS = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def ours():
    return pieces.Pieces(open(MODEL, "rb").read())


ALPHABET = st.sampled_from(
    ["a", "n", "the", "an", "in", "ing", "tion", " ", "  ", " " * 17, "▁", "\n", "é", "中", "\U0001f600", "&&&", "=", "<s>", "<0x0A>", "0", "00", "\x00"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_encoding_is_the_librarys(ours, library, text):
    ids = ours.encode([text])[0].tolist()
    assert ids == library.encode(text)
    assert ours.decode(np.array(ids, np.int32)) == library.decode(ids)


@pytest.mark.parametrize("text", ["=" * 3000, "in the" * 700, "a" * 9000, " " * 5000 + "x", "theanin" * 600])
def test_long_words(ours, library, text):
    assert ours.encode([text])[0].tolist() == library.encode(text)


def test_odd_documents_are_encoded(odd_docs, library):
    rows = pieces.encoded(odd_docs, MODEL).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert len(r.ids) == r.n_tokens and library.decode(list(r.ids)) == r.decoded
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_tokens == by_id[4].n_tokens == 0
    assert by_id[7].ids == library.encode(odd_docs.where("doc_id = 7").first().text)


def test_no_documents(no_docs):
    assert pieces.encoded(no_docs, MODEL).count() == 0
    assert packing.packed(no_docs, WORDS).count() == 0


def test_packed_pieces_are_the_documents_ids(odd_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.packed(odd_docs, WORDS, window=64).collect()
    found = {}
    for r in rows:
        assert zlib.crc32(np.array(r.ids, np.uint32).tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        found.setdefault(r.doc_id, []).append(r)
    for d in odd_docs.where("doc_id is not null and doc_id <> 2").collect():
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2]
        own = sorted(found[d.doc_id], key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == ids and {r.doc_tokens for r in own} == {len(ids)}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        size = sum(r.length for r in own)
        assert size == 64 or size & (size - 1) == 0 and size < 64


def test_level_minimises_the_sum_of_squares():
    """Against trying every level."""
    rng = np.random.default_rng(1)
    packer = packing.Packer(window=32, open_windows=10_000)
    for i, size in enumerate(rng.integers(1, 32, 400)):
        counts = packer.level[1:32].copy()
        best = None
        for fill in range(0, 33 - size):
            if fill == 0 or counts[fill - 1]:
                after = counts.copy()
                if fill:
                    after[fill - 1] -= 1
                if fill + size < 32:
                    after[fill + size - 1] += 1
                value = (int((after**2).sum()), -fill)
                best = value if best is None else min(best, value)
        assert packer._best_level(int(size)) == -best[1]
        packer.place(i, np.zeros(size, np.uint32))
    assert all(packer.level[f] == len(w) for f, w in packer.at_level.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "İ", "É", ".", ",", "!", "'s", "½", "́", " ", "\x1c", "\xa0", "<|endoftext|>", "<|ENDOFTEXT|>"]), max_size=20).map("".join))
def test_words_are_tokenised_apart(text):
    from tokenizers import Tokenizer

    global _words, _whole
    if "_words" not in globals():
        _words, _whole = packing.Words(open(WORDS).read()), Tokenizer.from_file(WORDS)
    assert np.frombuffer(_words.ids(text), np.uint32).tolist() == _whole.encode(text, add_special_tokens=False).ids


# --- token counts

VERSIONS = {"a": tokenizer_file("byte_bpe_50k.tiktoken"), "b": tokenizer_file("byte_bpe_multi_50k.tiktoken")}


def test_counts(odd_docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VERSIONS["a"], "rb"))}
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = rollup.counted(odd_docs, VERSIONS, P.PATTERN).where("tokenizer = 'a' and doc_id is not null").collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {r.doc_id: len(whole.encode_ordinary(texts[r.doc_id])) for r in rows}


def test_rollup(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, sign bigint, n_tokens bigint, n_chars bigint"
    changes = [
        [("s", "en", "a", 1, 10, 50), ("s", "en", "a", 1, 5, 20), (None, None, "a", 1, 0, 0)],
        [("s", "en", "a", -1, 5, 20), ("s", "en", "b", 1, 7, 20)],
        [("s", "en", "a", -1, 10, 50)],
    ]
    folder = rollup.Rollup(spark, (tmp_path / "r").as_uri())
    for i, rows in enumerate(changes):
        assert folder.commit(str(i), spark.createDataFrame(rows, schema))
        assert not folder.commit(str(i), spark.createDataFrame(rows, schema))  # idempotent
    expected = {("s", "en", "b", 1, 7, 20), (None, None, "a", 1, 0, 0)}
    assert {tuple(r) for r in folder.totals().collect()} == expected
    new = folder.compacted((tmp_path / "c").as_uri())
    newer = new.compacted((tmp_path / "d").as_uri())
    for compact in (new, newer):  # batches that are in the totals change nothing
        assert {tuple(r) for r in compact.totals().collect()} == expected
        assert not any(compact.commit(str(i), spark.createDataFrame(rows, schema)) for i, rows in enumerate(changes))
        assert compact.commit("more", spark.createDataFrame([("s", "en", "b", 1, 1, 2)], schema))
        assert ("s", "en", "b", 2, 8, 22) in {tuple(r) for r in compact.totals().collect()}
    assert rollup.Rollup(spark, (tmp_path / "none").as_uri()).totals().count() == 0
    assert rollup.Rollup(spark, (tmp_path / "none").as_uri()).compacted((tmp_path / "e").as_uri()).totals().count() == 0
    torn = tmp_path / "r" / "batch=torn"
    spark.createDataFrame([("s", "en", "b", 9, 9, 9)], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_chars bigint").write.parquet(str(torn))
    (torn / "_SUCCESS").unlink()
    assert {tuple(r) for r in folder.totals().collect()} == expected  # a batch that broke off
    with pytest.raises(Exception, match="without a sign"):
        folder.commit("bad", spark.createDataFrame([("s", "en", "a", None, 1, 1)], schema))
    assert not folder.committed("bad")


def test_maintained_totals_equal_a_recount(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 1), (8, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = {tuple(r[:3]): tuple(r[3:]) for r in rollup.maintained(odd_docs, labels, VERSIONS, P.PATTERN).collect()}
    counts = rollup.counted(odd_docs, VERSIONS, P.PATTERN).collect()
    expected = {}
    for r in counts:
        if r.doc_id == 7 or (r.tokenizer == "b") != (r.doc_id == 1):
            continue
        old = expected.get((r.source, r.lang, r.tokenizer), (0, 0, 0))
        expected[r.source, r.lang, r.tokenizer] = tuple(x + y for x, y in zip(old, (1, r.n_tokens, r.n_chars)))
    assert found == expected
    assert rollup.maintained(no_docs, labels, VERSIONS, P.PATTERN).count() == 0


def test_workers_keep_no_words_for_other_stages(spark):
    """A worker lives through many stages; what one of them kept would lie
    beside what every later one needs."""

    def held(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = sum(type(x).__name__ == "Words" for x in gc.get_objects())
        return pa.RecordBatch.from_arrays([pa.array([found], pa.int64())], ["n"])

    docs = spark.range(40, numPartitions=8).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    assert packing.packed(docs, WORDS).count() >= 40
    assert sum(r.n for r in per_batch(docs, held, "n bigint").collect()) == 0


def test_workers_give_freed_memory_back(spark):
    def freed(batch: pa.RecordBatch) -> pa.RecordBatch:
        # The last block lies above the others: without being told to, the C library gives none of them back.
        blocks = [bytes(100_000) for _ in range(1_000)]
        vars(sys)["_last_block"] = blocks[-1]
        return batch

    def resident(batch: pa.RecordBatch) -> pa.RecordBatch:
        kb = int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1])
        last = vars(sys).pop("_last_block", None)
        return pa.RecordBatch.from_arrays([pa.array([kb if last else 0], pa.int64())], ["kb"])

    one = spark.range(1, numPartitions=1)
    before = per_batch(one, lambda b: (vars(sys).update(_last_block=b"x"), b)[1], "id bigint")
    before.count()
    start = max(r.kb for r in per_batch(spark.range(8, numPartitions=8), resident, "kb bigint").collect())
    per_batch(one, freed, "id bigint").count()
    end = max(r.kb for r in per_batch(spark.range(8, numPartitions=8), resident, "kb bigint").collect())
    assert 0 < end < start + 50_000
