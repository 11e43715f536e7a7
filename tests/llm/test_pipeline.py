"""The pipeline against a plain reckoning of every stage, and the driver contract."""

import os
import random
import re
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline as cp  # noqa: E402
from candela.llm import secrets, store  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, docs_of, sf_of, words):
    rng = random.Random(8)
    item = words(30)
    bad = ["vile", "rotten", "nasty", "foul"]
    rows, labels = [], []
    for i in range(500):
        w = words(rng.randrange(20, 60)).split()
        toxic = rng.random() < 0.3
        for _ in range(4 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(toxic)))
    base = words(90)
    rows += [(600, base), (601, base), (602, base + " more"), (605, base.replace("w1 ", "v1 ", 1)), (610, f"{words(20)} {item}"),
             (611, f"{words(30)} password=0123456789abcdef {words(5)}"), (620, None), (621, ""), (622, words(4000))]
    docs = docs_of(rows, 4)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return dict(rows), sf_of(documents=docs, labels=given, benchmark=benchmark), {i for i, _, y in labels if y}


def _stage(spark, name, docs, sf):
    return dict(cp.STAGES)[name](spark, docs, sf)


def test_order_of_the_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "packing"]


def test_every_stage(spark, tables):
    rows, sf, toxic = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = _stage(spark, "toxicity", docs, sf)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert len((set(rows) - ids) ^ toxic) <= 0.05 * len(toxic) and {600, 601, 620, 621, 622} <= ids

    single = _stage(spark, "near_copies", docs, sf)
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == set(rows) - _copies(rows)

    clean = _stage(spark, "decontamination", docs, sf)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == set(rows) - {610}

    masked = _stage(spark, "secrets", docs, sf)
    assert masked.dtypes == docs.dtypes
    for r in masked.collect():
        if r["doc_id"] == 611:
            assert "[SECRET]" in r["text"] and "0123456789abcdef" not in r["text"] and r["n_chars"] == len(r["text"])
        elif not secrets.base_spans(rows[r["doc_id"]] or "") and "[SECRET]" not in (r["text"] or ""):
            assert r["text"] == rows[r["doc_id"]]


def _copies(rows):
    """Rows that a smaller id of their group stands for."""
    sets = {}
    for i, t in rows.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in rows}
    for i in sorted(rows):
        for j in sorted(rows):
            both = len(sets[i] & sets[j]) if i < j else 0
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    return {i for i, r in root.items() if r != i}


def test_run_packs_what_is_left(spark, tables):
    rows, sf, toxic = tables
    got = cp.run(spark, sf).collect()
    ids = {r["doc_id"] for r in got}
    assert 610 not in ids and 601 not in ids and {600, 611, 620, 621, 622} <= ids
    sums = Counter()
    for r in got:
        sums[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(n == total for (_, total), n in sums.items())


def test_run_deletes_what_the_next_stage_has_read(spark, sf_of, docs_of, monkeypatch):
    written = []
    monkeypatch.setattr(store, "shared_dir", lambda s, name, f=store.shared_dir: written.append(f(s, name)) or written[-1])
    monkeypatch.setattr(cp, "STAGES", [(n, lambda s, docs, sf: docs.where("doc_id > 0")) for n in "abcd"])
    sf = sf_of(documents=docs_of([(i, "x") for i in range(5)]))
    assert cp.run(spark, sf).count() == 4 and cp.table(spark, sf, "documents").count() == 5
    assert [os.path.exists(w.removeprefix("file:")) for w in written] == [False, False, True]


def test_stages_take_repeats_nulls_clashes_and_empty_tables(spark, tables):
    rows, sf, _ = tables
    text = rows[611]
    odd = [(1, text, "x", 1), (1, text, "x", 1), (1, "another text of one id", "x", 2), (None, None, None, None),
           (None, text, None, None), (2, rows[610], "y", 3), (3, "", "y", 0)]
    docs = spark.createDataFrame([(i, "c", t, l, n) for i, t, l, n in odd],
                                 "doc_id long, TEXT string, text string, lang string, n_chars long").repartition(2)
    with_lang = docs
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, with_lang, sf)
        assert out.columns == docs.columns
        n = out.count()
        if name == "near_copies":
            assert n == 5  # one of the three rows with the same text
        elif name == "decontamination":
            assert n == 6
        else:
            assert n <= 7
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_driver_contract(spark):
    queries, oracle = entry.queries(), entry.oracle_sql()
    for k in range(1, 11):
        assert sum(q.startswith(f"op{k}_") for q in queries) == 1
    assert "pipeline" in queries and set(oracle) <= set(queries)
