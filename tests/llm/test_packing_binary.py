import random
import zlib
from collections import Counter

import numpy as np
import pytest

from candela.llm import binary, packing

public_tokenizers = pytest.importorskip("public_tokenizers")
ROWS = [(3, "one two three"), (1, ""), (2, None), (None, "no id"), (5, "word " * 9000), (4, "same"), (4, "same"),
        (4, "other, same id"), (-7, "né  à\n\n x")]


def _ids(path, text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("seed", range(8))
def test_histogram_packs_fit_and_waste_little(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 64, 512])
    histogram = Counter(rng.randint(1, length) for _ in range(rng.choice([0, 1, 50, 4000])))
    patterns = packing.pack_histogram(histogram, length)
    used = Counter()
    for pattern, count in patterns:
        assert sum(s * n for s, n in pattern) <= length
        for s, n in pattern:
            used[s] += n * count
    assert used == +histogram
    tokens = sum(s * n for s, n in histogram.items())
    # worst fit, longest first: at most two half-empty packs meet
    assert sum(c for _, c in patterns) <= 2 * -(-tokens // length) + 1


def test_pieces_partition_the_ids(spark, docs_of, clashing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    for docs in (docs_of(ROWS), clashing(ROWS)):
        got = packing.pack_documents(docs, path, end_id=1, length=256, keep_ids=True).collect()
        sequences = {}
        by_doc = Counter()
        for r in got:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(ids) == r["length"] <= 256 and _crc(ids) == r["ids_crc32"]
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            by_doc[r["doc_id"], r["doc_tokens"]] += r["length"]
        for parts in sequences.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= 256
        assert sorted(sequences) == list(range(len(sequences)))
        expected = Counter()
        for i, t in ROWS:
            n = len(_ids(path, t, 1))
            expected[i, n] += n
        assert by_doc == expected


def test_a_length_that_most_share(docs_of):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs_of([(i, "a b c") for i in range(1000)], 7), path, 1, 64).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 1000
    assert len({r["sequence_id"] for r in got}) == -(-1000 // (64 // 4))


def test_files_hold_every_document_in_order(spark, docs_of, clashing):
    path = public_tokenizers.path("word_bpe_49k.json")
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for docs in (docs_of(ROWS), clashing(ROWS)):
        files = binary.write_token_files(docs, path, end_id=2)
        got = sorted(binary.read_token_files(spark, files).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == [i for i, _ in order]
        at = 0
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
            (i, len(_ids(path, t, 2)), _crc(_ids(path, t, 2))) for i, t in ROWS)
        assert files.dtype == "<u2"


def test_empty_tables(spark, docs_of):
    path = public_tokenizers.path("word_bpe_49k.json")
    files = binary.write_token_files(docs_of([]), path, 2)
    assert files.parts == [] and binary.read_token_files(spark, files).count() == 0
    assert packing.pack_documents(docs_of([]), path, 1).count() == 0
