"""Whitening, the chosen-path join and the filter audit against brute force."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from adlake.llm import chosen_path, filter_audit, whitening
from adlake.llm.common import start
from adlake.session import cut_lineage
from tests.llm.test_dedup import WORD, corpus, find  # noqa: F401  (corpus is a fixture)

VECTORS = "vec_id long, embedding array<float>, label int, x array<int>, n long, component string, digest string, key string"


def vectors_of(spark, rows):
    return start(spark).createDataFrame([(i, v, 1, [1], 9, "c", "d", "k") for i, v in rows], VECTORS)


def reference(vectors, weights=None):
    """x, n, deviations, and whitened entries up to sign of the four leading components."""
    x = np.floor(np.array(vectors, np.float32).astype(float) * 256).astype(np.int64)
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    w = counts if weights == "count" else np.ones(len(distinct), np.int64)
    n, sums = int(w.sum()), (distinct * w[:, None]).sum(axis=0)
    centred = distinct - sums / n
    values, axes = np.linalg.eigh((centred * w[:, None]).T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = (x - sums / n) @ axes[:, :4] / np.sqrt(values[:4])
    return n, ((n * x - sums) ** 2).sum(axis=1), white, values[:4] / values.sum()


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening_of_repeated_vectors(spark, by_count, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    draw = np.random.default_rng(3)
    base = (draw.normal(size=(200, 6)) * [5, 4, 3, 2, 1, 0.5] + 40).astype(np.float32)
    vectors = np.concatenate([base, base[:1].repeat(100, 0), base[:20]])
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, [1.0]), (905, [])]
    table = vectors_of(spark, [(i, v.tolist()) for i, v in enumerate(vectors)] + odd).repartition(7)
    n, deviation, white, explained = reference(vectors, "count" if by_count else None)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(table, by_count=by_count).collect()}
    assert set(got) == {(i, c) for i in range(len(vectors)) for c in (1, 2, 3, 4)}
    mine = np.array([[got[i, c].whitened for c in (1, 2, 3, 4)] for i in range(len(vectors))])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-9
    for (i, c), r in got.items():
        assert (r.n, r.deviation) == (n, deviation[i])
        assert r.explained == pytest.approx(explained[c - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_odd_tables(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, None)])).count() == 0
    alone = whitening.whiten(vectors_of(spark, [(1, [0.5, 2.0]), (1, [0.5, 2.0]), (None, [0.5, 2.0])])).collect()
    assert len(alone) == 6 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in alone} == {(0.0, 0.0, 0.0, 0)}
    huge = whitening.whiten(vectors_of(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and any(r.deviation is None for r in huge)


def brute_components(texts, share):
    sets = {}
    for i, text in texts:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    parent, ids = {i: i for i in sets}, sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inside = len(sets[a] & sets[b])
            if inside and 100 * inside >= share * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(parent, i)) for i in sets}


@pytest.mark.parametrize("small", [chosen_path.SMALL, 8])
def test_chosen_path_components(docs, corpus, small):  # noqa: F811
    """With one block per node, and with nodes that branch and are compared block against block."""
    want = brute_components(corpus, 85)
    got = chosen_path.deduplicate(docs(corpus), small=small).collect()
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chosen_path_recall_near_the_threshold(docs):
    """Independent pairs with a similarity of 0.85 to 0.92: nearly all must meet in one of the trees."""
    draw, texts = random.Random(9), []
    for i in range(300):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randint(70, 200))]
        texts.append((2 * i, " ".join(words)))
        words[draw.randrange(10, len(words) - 10)] = "other"
        texts.append((2 * i + 1, " ".join(words)))
    linked = 0
    for k in range(0, 600, 2):
        want = brute_components(texts[k : k + 2], 85)
        linked += want[k + 1][1] == k
    got = {r.doc_id: r.component_id for r in chosen_path.deduplicate(docs(texts)).collect()}
    found = sum(got[k + 1] == k for k in range(0, 600, 2))
    assert linked > 200 and 0.99 * linked <= found <= linked


def test_chosen_path_pairs_of_a_large_group_grow_linearly(docs):
    """Near copies of one text, nearly all at 0.85 or more from it and below that from one another."""
    emitted = {}
    for size in (200, 800):
        draw = random.Random(4)
        base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        texts = [(0, " ".join(base))]
        for i in range(1, size):
            words = list(base)
            for at in draw.sample(range(10, 290), 4):
                words[at] = f"e{i}-{at}"
            texts.append((i, " ".join(words)))
        table = docs(texts)
        info = cut_lineage(chosen_path.profile(table)).where("n > 0")
        rows = info.selectExpr("doc_id", "explode(nodes) AS node")
        nodes = chosen_path.shared_nodes(rows).selectExpr("node", "doc_id", "doc_id AS c", "m")
        members = cut_lineage(chosen_path.members_of(nodes, info, chosen_path.SMALL))
        emitted[size] = chosen_path.central_pairs(members).count()
        got = chosen_path.deduplicate(table).collect()
        assert {r.component_id for r in got} == {0}
    assert emitted[800] <= 8 * emitted[200]


def test_chosen_path_without_links_or_rows(docs):
    assert chosen_path.deduplicate(docs([]).limit(0)).count() == 0
    got = chosen_path.deduplicate(docs([(1, "a b"), (2, "c d"), (3, None), (None, "a b"), (5, "A  b"), (5, "A  b")])).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == [
        "(1, 1, 1, True)", "(2, 1, 2, True)", "(3, 0, 3, True)", "(5, 1, 1, False)", "(5, 1, 1, False)", "(None, 1, None, True)",
    ]


def audit_by_hand(documents, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in documents:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, source in documents:
        text = text or ""
        words = WORD.findall(text)
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * (i is not None and text in least and i > least[text])
        rows.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                cells = [0] * 6
                for _, fails, g, t in mine:
                    earlier = bool(before & set(fails))
                    cells[0] += not earlier and letter not in fails
                    removed = not earlier and letter in fails
                    cells[1] += removed
                    cells[2] += earlier and letter in fails
                    cells[3] += fails == letter
                    cells[4] += removed and g
                    cells[5] += removed and t
                shapley[letter] += cells[1]
                out[part, order, step] = cells
        for (p, order, step), cells in out.items():
            if p == part:
                out[p, order, step] = [*cells, shapley[order[step - 1]]]
    return out


@pytest.mark.parametrize("block, step, bucket", [(1 << 25, 1 << 22, 1 << 15), (3000, 1000, 4)])
def test_filter_audit(spark, docs, block, step, bucket, monkeypatch):
    for name, value in (("BLOCK", block), ("STEP", step), ("BUCKET_ROWS", bucket)):
        monkeypatch.setattr(filter_audit, name, value)
    draw = random.Random(8)

    def text(n, size, upper=0.0, mark=""):
        return mark.join(" ".join(w.upper() if draw.random() < upper else w for w in [f"wörd{draw.randrange(size)}" for _ in range(n)]).split("\t"))

    documents = [(i, text(draw.choice([3, 198, 199, 200, 201, 400]), draw.choice([50, 5000]), draw.choice([0, 0.02, 0.3])), f"s{i % 3}") for i in range(60)]
    documents += [(100 + i, documents[i][1] + draw.choice(["", "", "#", " a|b", "*"]), "s1") for i in range(30)]
    documents += [(200, None, None), (201, "", "s0"), (202, "\x00  x", None), (203, " ".join(["same"] * 5000), "s2"), (None, documents[3][1], "s2"), (5, documents[5][1], "s1")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    table = docs([(i, t, s) for i, t, s in documents]).repartition(3)
    marks = spark.createDataFrame([(i, q, t, "x", 1) for i, q, t in labels], "doc_id long, quality int, toxic int, part string, failed int")
    got = filter_audit.audit(table, marks).collect()
    want = audit_by_hand(documents, labels)
    assert len(got) == len(want)
    for r in got:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] == want[r.part, r.filter_order, r.step]
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    con.register("labels", marks.toPandas())
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(con.execute(f"SELECT {', '.join(names)} FROM ({filter_audit.ORACLE})").fetchall()) == sorted(tuple(r[n] for n in names) for r in got)


def test_filter_audit_of_nothing(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs([]).limit(0), labels).count() == 0


def test_term_matrix_counts_words(docs, monkeypatch):
    """Rows of the shards hold the global numbers of the words and their counts."""
    monkeypatch.setattr(filter_audit, "BLOCK", 40)
    texts = [(i, t, "p") for i, t in enumerate(["a b a", "", "b c", None, "c a d d d", "zz " * 40])]
    table = docs(texts).selectExpr("doc_id", "source AS part", "text")
    blocks = cut_lineage(filter_audit.encode_blocks(table))
    words = {r.id: bytes(r.word).decode() for r in filter_audit.dictionary(blocks).collect()}
    assert sorted(words.values()) == ["a", "b", "c", "d", "zz"]
    got = {}
    for shard in filter_audit.term_matrix(blocks).collect():
        for k, i in enumerate(shard.doc_id):
            span = slice(shard.indptr[k], shard.indptr[k + 1])
            got[i] = {words[c]: n for c, n in zip(shard.columns[span], shard.counts[span])}
    assert got == {0: {"a": 2, "b": 1}, 1: {}, 2: {"b": 1, "c": 1}, 3: {}, 4: {"c": 1, "a": 1, "d": 3}, 5: {"zz": 40}}


def test_packed_numbers():
    for numbers in ([], [0], [5, 0, 2**31 - 1, 3, 3], list(range(1000, 0, -1))):
        assert filter_audit.unpack(filter_audit.pack(np.array(numbers, np.int64))).tolist() == numbers
