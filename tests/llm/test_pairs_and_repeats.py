import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from candela import session
from candela.llm import jaccard, repeats, store

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def _components(rows, size, percent):
    """Brute force: (id, set size, smallest id) of every row."""
    sets = [_shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


def _got(docs, size=4, percent=85):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                   for r in jaccard.link_documents(docs, size, percent).collect())


def _edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_jaccard_edge_cases(spark, docs_of, clashing, words):
    base = words(60)
    rows = [(5, base), (2, base.upper()), (9, base), (9, base), (None, base), (7, None), (8, ""), (6, " \t\n"), (1, "one two"),
            (4, "ONE\x0btwo"), (3, "two one"), (10, "a b c d"), (11, "a b c d e"), (12, words(30_000)), (None, None)]
    for docs in (docs_of(rows), clashing(rows)):
        assert _got(docs) == _components(rows, 4, 85)
    assert _got(docs_of([])) == Counter()


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_against_all_pairs(docs_of, words, seed, monkeypatch):
    """Chains of near copies around the threshold, a passage that many share, and copies."""
    monkeypatch.setattr(jaccard, "FREQUENT", 50)
    rng = random.Random(seed)
    passage = words(12)
    texts = [words(rng.randrange(1, 120), 5000) for _ in range(60)]
    texts += [f"{t} {passage}" for t in texts[:30]]
    family = words(150, 5000)
    texts += [_edited(rng, family, rng.choice([0, 0.005, 0.015, 0.03, 0.05])) for _ in range(80)]
    for _ in range(40):
        texts.append(_edited(rng, texts[-1], 0.02))
    texts += rng.choices(texts, k=20)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    for size, percent in ((4, 85), (5, 80)):
        expected = _components(rows, size, percent)
        assert len({c for _, _, c in expected}) < len(rows)
        assert _got(docs_of(rows, 5), size, percent) == expected


@pytest.mark.parametrize("heavy", (0, 3, 30))
def test_heavy_tokens_against_all_pairs(docs_of, words, heavy, monkeypatch):
    """Pairs whose common tokens are heavy in part or all, and blocks compared in several rounds."""
    for name, value in (("FREQUENT", 20), ("HEAVY", heavy), ("BLOCK_NODES", 4), ("ROUND_BYTES", 1)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(heavy)
    lines = [words(6) for _ in range(4)]
    texts = [" ".join(rng.sample(lines, rng.randrange(3)) + [words(rng.randrange(1, 40))]) for _ in range(50)]
    for _ in range(4):
        family = words(rng.choice([25, 60, 100]), 3000)
        texts += [_edited(rng, f"{family} {rng.choice(lines)}", rng.choice([0.01, 0.02, 0.04])) for _ in range(30)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    expected = _components(rows, 4, 85)
    assert 60 < len({c for _, _, c in expected}) < len(rows)
    assert _got(docs_of(rows, 5)) == expected


def test_a_heavy_token_alone_brings_no_blocks_together(spark, docs_of, words, monkeypatch):
    """Blocks are shuffled once for each pair of them: who shares too little to link stays out."""
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "HEAVY", 50)
    lines, met = [words(4) for _ in range(6)], []
    rows = [(i, f"{lines[i % 6]} {words(20)}") for i in range(360)]
    blockwise = jaccard._blockwise
    monkeypatch.setattr(jaccard, "_blockwise", lambda nodes, *a: met.append(nodes.count()) or blockwise(nodes, *a))
    assert _got(docs_of(rows, 3)) == _components(rows, 4, 85)
    assert met == [0]


def test_the_joins_tables_and_shuffles_go(spark, docs_of, words, monkeypatch):
    base, written = words(80), []
    monkeypatch.setattr(store, "shared_dir", lambda s, name, f=store.shared_dir: written.append(f(s, name)) or written[-1])
    rows = [(i, f"{base} {words(2)}") for i in range(20)]
    assert _got(docs_of(rows)) == _components(rows, 4, 85)
    there = [p for p in (w.removeprefix("file:") for w in written) if os.path.exists(p)]
    assert 20 < len(written) and {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in there} <= {"survey", "edges", "clusters-placed"}
    assert spark.conf.get(session._SHUFFLES_GO, None) is None


def test_the_driver_gets_the_frequent_tokens_alone(spark, monkeypatch):
    rng = random.Random(4)
    counts = {rng.randrange(-2**63, 2**63): rng.choice([1, 2, 2, 2, 3, 9]) for _ in range(3000)}
    survey = spark.createDataFrame(
        [(None, None, None, t, 1) for t, k in counts.items() for _ in range(k)] + [(1, 2, 3, None, None)],
        "doc_id long, node long, n long, token long, k long").repartition(5)
    kind, plans = type(survey), []
    for name in ("toArrow", "toPandas", "collect"):
        monkeypatch.setattr(kind, name, lambda self, f=getattr(kind, name): (
            plans.append(self._jdf.queryExecution().executedPlan().toString()), f(self))[1])
    more = [t for t, k in counts.items() if k > 2]
    ties = sorted(t for t, k in counts.items() if k == 2)
    for most in (0, len(more), len(more) + 700, len(more) + len(ties), len(counts)):
        monkeypatch.setattr(jaccard, "FREQUENT", most)
        tokens, k = jaccard._frequent(survey)
        got = dict(zip(tokens.view(np.int64).tolist(), k.tolist(), strict=True))
        assert len(got) == len(tokens) <= most and all(counts[t] == x for t, x in got.items())
        assert len(got) > most - 10 and (set(more) <= set(got) or not most)
        if most == len(more) + 700:  # the smallest of equally frequent ones
            assert set(got) - set(more) == set(ties[:len(got) - len(more)])
    assert plans and not any("TakeOrdered" in p for p in plans)
    tokens, k = jaccard._frequent(survey.limit(0))
    assert len(tokens) == len(k) == 0


def test_tasks_give_small_batches(docs_of, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60_000))
    given = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3]), "text": pa.array([text, text, None])})
    docs = docs_of([(1, "")])
    runs = []
    monkeypatch.setattr(jaccard, "released", lambda run: runs.append(run) or run)
    monkeypatch.setattr(jaccard, "staged", lambda df, name: df)
    jaccard._survey(docs, 4)
    jaccard._map_sets(docs, 4, "token long", lambda rows, sets: {"token": np.concatenate(sets).view(np.int64)})
    for run, tokens in zip(runs, (59_997, 2 * 59_997), strict=True):
        batches = list(run([given]))
        assert max(b.num_rows for b in batches) <= store.GIVEN_ROWS
        assert sum(b.num_rows - b.column("token").null_count for b in batches) == tokens


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (100, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in jaccard.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 300: 100}


def _brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw, strict=True):
        cover = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                cover[s:s + length] = True
        left = bytes(x for x, c in zip(b, cover, strict=False) if not c)
        spans = int((cover[1:] & ~cover[:-1]).sum() + cover[0])
        out.append((d, len(b), int(cover.sum()), spans, hashlib.sha256(left).hexdigest(), left))
    return Counter(out)


def _removed(docs, length):
    got = repeats.remove_repeats(docs, length).collect()
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in got)


def _repetitive(words, rng):
    base = words(120, 5000)
    passage = words(15, 5000)
    texts = [words(60, 5000), base, base, base[:300], base[5:], "ab" * 200, "x" * 150, "x" * 300, passage + words(20),
             words(20) + passage, passage * 3, "é" * 100, "zé" * 80, "", None]
    texts += [_edited(rng, base, 0.02) for _ in range(25)]
    return list(enumerate(texts))


@pytest.mark.parametrize("hot", [4096, 0])
def test_repeats_against_brute_force(docs_of, words, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    rng = random.Random(hot)
    rows = _repetitive(words, rng) + [(None, "id " + words(60)), (3, words(50)), (3, words(50))]
    for length in (64, 100):
        assert _removed(docs_of(rows), length) == _brute(rows, length)


@pytest.mark.parametrize("hot", [6, 30])
def test_no_index_meets_more_than_a_hot_group(docs_of, words, hot, monkeypatch):
    """A passage that many documents share, with other text before and after it."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    met, marks = [], repeats._marks

    def counted(segments, length):
        met.extend(r["count"] for r in segments.groupBy("g").count().collect())
        return marks(segments, length)

    monkeypatch.setattr(repeats, "_marks", counted)
    rng, passage = random.Random(hot), words(90, 5000)
    texts = [f"{words(30, 5000)} {passage[rng.randrange(4):]} {words(30, 5000)}" for _ in range(60)]
    texts += [_edited(rng, f"{words(5, 5000)} {passage}", 0.02) for _ in range(20)]
    rows = list(enumerate(texts))
    assert _removed(docs_of(rows), 100) == _brute(rows, 100)
    assert met and max(met) <= hot


def test_only_segments_with_a_core_in_common_are_indexed(docs_of, words, monkeypatch):
    """A phrase shorter than what counts as a repeat gives many documents an anchor in common."""
    sizes, marks = [], repeats._marks

    def counted(segments, length):
        sizes.append(segments.count())
        return marks(segments, length)

    monkeypatch.setattr(repeats, "_marks", counted)
    phrase, twin = words(40, 5000), words(90, 5000)
    rows = [(k, f"{words(90, 5000)} {phrase} {words(90, 5000)}") for k in range(40)]
    assert _removed(docs_of(rows), 400) == _brute(rows, 400)
    assert sum(sizes) == 0
    rows += [(40, twin), (41, twin[:420] + "!" + twin[421:])]
    assert _removed(docs_of(rows), 400) == _brute(rows, 400)
    assert sum(sizes) >= 2


def test_texts_are_dealt_once(docs_of, words):
    """Lists of ranges come to bucketed texts, without another exchange of the texts."""
    twin = words(90)
    plan = repeats.remove_repeats(docs_of([(1, twin), (2, twin), (3, words(9))]), 400)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "BroadcastExchange" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the lists


def test_repeats_edges(docs_of, clashing, words):
    rows = [(1, None), (2, ""), (3, "short"), (4, words(80)), (4, None), (None, "y" * 500)]
    rows += [rows[3]]
    for docs in (docs_of(rows), clashing(rows)):
        assert _removed(docs, 400) == _brute(rows, 400)
    assert _removed(docs_of([]), 400) == Counter()


@pytest.mark.parametrize("seed", range(20))
def test_run_length_index_marks_what_repeats(seed):
    rng = random.Random(seed)
    alphabet = bytes(rng.sample(range(256), rng.choice([1, 2, 4])))
    strings = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(1, 9))]
    strings += rng.choices(strings, k=2)
    index = repeats.RunLengthIndex(strings)
    assert index.run_lengths.sum() == sum(map(len, strings)) + len(strings)
    for length in (7, 10, 20):
        first, last = index.repeated(length)
        marked = {p for a, b in zip(first.tolist(), last.tolist(), strict=True) for p in range(a, b + 1)}
        seen = Counter(s[k:k + length] for s in strings for k in range(len(s) - length + 1))
        expected = {int(index.begin[i]) + k for i, s in enumerate(strings) for k in range(len(s) - length + 1)
                    if seen[s[k:k + length]] > 1}
        assert marked == expected
