"""Periodic runs, SimHash and whitening against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from portrait.llm import bytesops as B
from portrait.llm import periodic_runs, simhash, whitening
from portrait.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- periodic runs
def runs_by_comparison(words):
    """(start, length, period) of every run: all shifts, smallest period of a stretch."""
    code = {}
    w = np.array([code.setdefault(x, len(code)) for x in words], np.int64)
    out = {}
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate(([0], (w[q:] == w[:-q]).astype(np.int8), [0]))
        edge = np.diff(same)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if b - a + q >= max(12, 2 * q):
                out.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def reported(doc_id, text, plant):
    w = WHITE.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = runs_by_comparison(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return {"doc_id": doc_id, "n_words": len(w), "n_runs": len(runs), "start": s, "length": n, "period": q,
            "exponent_milli": 1000 * n // q if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()}


def same_rows(df, wanted):
    key = lambda r: repr(sorted(r.items()))
    assert sorted((r.asDict() for r in df.collect()), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("plant", [True, False])
def test_periodic_runs_of_the_table(llm, plant):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").filter("length(text) < 20000 or text is null")
    same_rows(periodic_runs.report(docs, plant=plant), [reported(r.doc_id, r.text, plant) for r in docs.collect()])


def test_periodic_runs_edges(llm, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    rows += [(20, "a b " * 50 + "c " + "a b " * 20), (21, "x y z " * 300), (21, "x y z " * 300), (22, "q r " * 6),
             (None, "u v w x " * 9), (23, " ".join(["a b a b a b a"] * 2) + " tail"), (24, "\x0bone\x0cone\rone " * 7)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    small = docs.filter("length(text) < 20000 or text is null")
    same_rows(periodic_runs.report(small, plant=True), [reported(*r, True) for r in rows if len(r[1] or "") < 20000])
    assert periodic_runs.report(edge, plant=True).count() == edge.count()
    assert periodic_runs.report(empty).count() == periodic_runs.spans(empty).count() == 0
    spans = periodic_runs.spans(small).collect()
    assert sorted((r.start, r.length, r.period) for r in spans if r.doc_id == 20) == runs_by_comparison(rows[-7][1].split())
    out = {r.doc_id: r for r in periodic_runs.collapse(edge).collect()}
    assert periodic_runs.collapse(edge).columns == edge.columns
    assert out[10].text == "same row" and out[10].key == "clash" and out[3].text is None and out[8].text.startswith("x" * 1000)


def _sequence(rnd, kind):
    if kind == "touching":                                # regions of one period that meet out of phase
        p = rnd.randrange(1, 6)
        u, w = [rnd.randrange(2) for _ in range(p)] * 60, []
        while len(w) < 300:
            w += u[rnd.randrange(p):][:rnd.randrange(1, 150)]
        return w
    if kind == "nested":
        def part(depth):
            if not depth or rnd.random() < 0.1:
                return [rnd.randrange(3) for _ in range(rnd.randrange(1, 4))]
            return part(depth - 1) * rnd.randrange(1, 4) + (part(depth - 1) if rnd.random() < 0.5 else [])
        return part(5)[:500]
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < 400:
            a, b = b, b + a
        b[rnd.randrange(len(b))] ^= rnd.randrange(2)
        return b
    return [rnd.randrange(2) for _ in range(rnd.randrange(1, 400))]


@pytest.mark.parametrize("kind", ["touching", "nested", "fibonacci", "random"])
def test_periodic_runs_of_sequences(kind):
    rnd = random.Random(kind)
    for _ in range(60):
        w = _sequence(rnd, kind)
        s, e, q = periodic_runs.runs_of(B.mix(np.array(w, np.uint64) + np.uint64(7)), len(w))
        assert sorted(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True)) == runs_by_comparison(w), w


def test_touching_regions_need_their_own_proposals(monkeypatch):
    """Without step 3 of the method runs are lost."""
    monkeypatch.setattr(periodic_runs, "_touching", lambda *a: (periodic_runs._Z, periodic_runs._Z))
    w = ([0, 1] * 20)[:25] + ([0, 1] * 20)[:25]
    s, e, q = periodic_runs.runs_of(B.mix(np.array(w, np.uint64) + np.uint64(7)), len(w))
    assert len(s) < len(runs_by_comparison(w))


# ---------------------------------------------------------------------- SimHash
def fingerprint(text, words=4):
    w = WHITE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] if w else []
    h = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_ids(rows):
    """Smallest id per row of (id, fingerprint), by comparing all pairs."""
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                up[top(i)] = top(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[top(i)] += [d] if d is not None else []
    return [min(least[top(i)], default=None) for i in range(len(rows))]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 16])
def test_simhash(llm, edge, empty, bucket):
    table = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    for docs in (table, edge, empty):
        rows = [(r.doc_id, fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        wanted = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, least_ids(rows), strict=True)), key=repr)
        got = simhash.join(docs, bucket=bucket)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(map(tuple, got.collect()), key=repr) == wanted


def test_covering_masks():
    rnd = random.Random(5)
    level = [0]
    for _ in range(3):
        outside = rnd.choice(level)
        level = simhash.covering(outside)
        for _ in range(2000):
            x = y = rnd.getrandbits(64)
            for i in rnd.sample([i for i in range(64) if not outside >> i & 1], rnd.randrange(5)):
                y ^= 1 << i
            assert any(x & m == y & m for m in level)
            assert not any(x & m == y & m for m in level) or (x ^ y) & outside == 0
        assert all(m & outside == outside and m != outside for m in level)
    left = max(64 - m.bit_count() for a in simhash.covering() for b in simhash.covering(a) for m in simhash.covering(b))
    assert 1 << left < simhash.BUCKET


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 32])
def test_a_cluster_of_fingerprints_is_one_component(llm, bucket):
    """All fingerprints within two bits of one: buckets beyond the limit are dealt again."""
    rnd = random.Random(9)
    c, far = rnd.getrandbits(64), rnd.getrandbits(64)
    near = {c ^ (1 << i) ^ (1 << j if i != j else 0) for i in range(40) for j in range(i + 1)} | {c}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = llm.createDataFrame([(signed(x),) for x in [*near, far]], "fp long")
    links = simhash.links(nodes, bucket=bucket)
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in links.distinct().collect())
    from portrait.llm.components import components
    got = {r.node: r.component for r in components(links).collect()}
    assert set(got) == {signed(x) for x in near} and len(set(got.values())) == 1


def test_forest_has_no_more_links_than_nodes():
    x = np.arange(16, dtype=np.uint64)                       # all within four bits of each other
    a, b = (np.concatenate(c) for c in zip(*simhash.forest(x), strict=True))
    assert len(a) == 15 and len(set(b.tolist())) == 15


# -------------------------------------------------------------------- whitening
def whitened(rows, k=8):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows], np.int64)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), (y @ u) / np.sqrt(e), e / np.trace(y.T @ y / n)


def check_whitened(df, rows):
    n, deviation, w, share = whitened(rows)
    got = df.orderBy("vec_id", "component").collect()
    assert len(got) == len(rows) * w.shape[1]
    at = {d: i for i, (d, _) in enumerate(rows)}
    out = np.zeros_like(w)
    for r in got:
        i, k = at[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviation[i]) and abs(r.explained - share[k]) < 1e-9 * share[k] + 1e-12
        assert r.identity_error < 1e-6
        out[i, k] = r.whitened
    sign = np.sign((out * w).sum(axis=0))
    assert np.abs(out * sign - w).max() < 1e-6


def test_whitening_of_the_table(llm):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(QUERIES["op13_whitening"](llm, SMALL), rows)


def test_whitening_edges(llm):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.standard_normal(5)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, []),
           (105, [1.0, 2.0])]
    df = llm.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumn("component", F.lit("clash"))
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    check_whitened(whitening.whiten(df), good)
    assert whitening.whiten(df.limit(0)).count() == whitening.whiten(df.filter("vec_id > 100 and vec_id < 105")).count() == 0
    twice = whitening.whiten(df.filter("vec_id = 1").union(df.filter("vec_id = 1"))).collect()
    assert [r.whitened for r in twice] == [None] * 10 and {r.deviation for r in twice} == {0} and {r.explained for r in twice} == {None}
    nameless = df.filter("vec_id < 40").withColumn("vec_id", F.expr("nullif(vec_id, 3)"))
    assert whitening.whiten(nameless).filter("vec_id is null").count() == 5
    assert whitening.whiten(df, components=2).count() == 80


@pytest.mark.parametrize("kind", ["plain", "falling", "equal", "groups", "low rank", "zero"])
@pytest.mark.parametrize("d", [1, 2, 9, 40])
def test_leading_eigenvectors(d, kind):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d + 3))
    if kind == "falling":
        a *= np.geomspace(1, 1e-8, d)[:, None]
    v = a @ a.T
    if kind == "equal":
        v = np.eye(d) * 3
    if kind == "groups":
        q, _ = np.linalg.qr(a[:, :d])
        v = (q * np.repeat([5.0, 5, 2, 1], d)[:d]) @ q.T
        v = (v + v.T) / 2
    if kind == "low rank":
        v = a[:, :1 + d // 3] @ a[:, :1 + d // 3].T
    if kind == "zero":
        v = np.zeros((d, d))
    k = min(8, d)
    values, axes = whitening.leading(v, k)
    e = np.linalg.eigvalsh(v)
    size = max(abs(e).max(), 1e-300)
    assert np.abs(values - e[::-1][:k]).max() <= 1e-12 * size
    assert np.abs(v @ axes - axes * values).max() <= 1e-12 * size
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-9
    for s in rng.uniform(-1, 1, 5) * size:
        assert whitening.inertia(v - s * np.eye(d)) == (e < s).sum()
