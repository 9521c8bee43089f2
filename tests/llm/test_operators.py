"""Each operator against a brute-force version on sf0.001 and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from portrait.llm import (
    bytesops,
    chat_format,
    components,
    decontaminate,
    license_scan,
    lm_score,
    ngram_join,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    suffix_dedup,
    url_filter,
)
from portrait.llm.queries import QUERIES, VOCABULARY

SMALL = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(text):
    return (text or "").translate(LOWER)


@pytest.fixture(scope="module", params=["table", "edge", "empty"])
def docs(request, llm, edge, empty):
    return {"table": lambda: llm.read.parquet(f"{SMALL}/documents.parquet"), "edge": lambda: edge,
            "empty": lambda: empty}[request.param]()


def rows_of(df):
    return sorted((tuple(r.asDict(True).items()) for r in df.collect()), key=repr)


def expect(df, wanted, *cols):
    got = sorted(([r[c] for c in cols] for r in df.collect()), key=repr)
    assert got == sorted(([w[c] for c in cols] for w in wanted), key=repr)


# ------------------------------------------------------------- decontamination
def scanned(docs, bench, n=13):
    windows = defaultdict(set)
    for item, text in bench:
        w = ALNUM.findall(low(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i:i + k])].add(str(item))
    out = []
    for d, text in docs:
        w = ALNUM.findall(low(text))
        hit, items = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    items |= windows[tuple(w[i:i + k])]
        out.append({"doc_id": d, "n_words": len(w), "n_hit": len(hit), "n_items": len(items),
                    "items_sha256": hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(),
                    "contaminated": bool(hit) and 20 * len(hit) >= len(w)})
    return out


COLS1 = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def benchmark(llm):
    b = llm.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    own = llm.createDataFrame([(900, "One two"), (901, None), (902, ""), (903, " ".join(f"passage{i}" for i in range(40)))],
                              "item_id long, text string")
    return b.union(own)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 40])
def test_decontaminate(llm, docs, block):
    bench = benchmark(llm)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = decontaminate.scan(docs, bench, block_windows=block)
    wanted = scanned(texts, [tuple(r) for r in bench.collect()])
    expect(got, wanted, *COLS1)
    bad = {w["doc_id"] for w in wanted if w["contaminated"]}
    kept = decontaminate.remove(docs, bench, block_windows=block)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, _ in texts} - bad


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WINDOWS, 5])
def test_decontaminate_items_without_id(llm, block):
    """Against the query's SQL; the windows of such items cut and drop documents too."""
    import duckdb

    from portrait.llm.oracle import ORACLE_SQL
    text = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    docs = [(0, text("a")), (1, "x " * 900 + text("b")), (2, text("a") + " " + text("c")), (3, text("d")), (None, text("b")), (4, None)]
    bench = [(None, text("a")), (None, text("b", 20)), (7, text("c")), (8, text("a", 15)), (None, None), (None, ""), (9, None)]
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", bench)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    df, items = llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(bench, "item_id long, text string")
    # the SQL joins by document id, so the row without one is looked at below
    wanted = con.execute(f"SELECT {', '.join(COLS1)} FROM ({ORACLE_SQL['op1_decontaminate']}) WHERE doc_id IS NOT NULL").fetchall()
    found = decontaminate.scan(df, items, block_windows=block).collect()
    assert sorted([tuple(r[c] for c in COLS1) for r in found if r.doc_id is not None]) == sorted(wanted)
    got = {r.doc_id: r for r in found}
    assert (got[0].n_hit, got[0].n_items, got[0]["items"]) == (40, 2, [None, "8"])
    assert (got[None].n_hit, got[None].n_items, got[None]["items"]) == (20, 1, [None])
    assert got[1].n_hit == 20 and not got[1].contaminated and got[3].n_hit == 0
    assert {r.doc_id for r in decontaminate.remove(df, items, block_windows=block).collect()} == {1, 3, 4}


def test_decontaminate_spans_and_no_benchmark(llm, edge):
    bench = benchmark(llm)
    cut = decontaminate.remove(edge, bench, what="spans")
    assert cut.count() == edge.count()
    assert {r.doc_id for r in decontaminate.scan(cut, bench).filter("n_hit > 0").collect()} == set()
    assert decontaminate.scan(edge, bench.limit(0)).filter("n_hit > 0").count() == 0


# ------------------------------------------------------------- SentencePiece
@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_codec.Vocabulary.load(VOCABULARY)


def best_path(v, text):
    """The whole lattice, by the operator's tie rule."""
    if not text:
        return []
    text = "▁" + text.replace("▁", "\ud800").replace(" ", "▁")
    best = [(0.0, None, None)] + [None] * len(text)
    for at in range(1, len(text) + 1):
        for start in range(max(0, at - v.longest), at):
            hit = v.pieces.get(text[start:at]) or ((-1, v.unknown) if at - start == 1 else None)
            if hit and (best[at] is None or best[start][0] + hit[1] > best[at][0]):
                best[at] = best[start][0] + hit[1], start, hit[0]
    out, at = [], len(text)
    while at:
        _, start, piece = best[at]
        char = "▁" if text[start] == "\ud800" else text[start]
        out[:0] = [piece] if piece >= 0 else [v.byte_ids[b] for b in char.encode()]
        at = start
    return out


def test_sentencepiece(docs, vocabulary):
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    encoded = sentencepiece_codec.encode(docs, vocabulary)
    back = sentencepiece_codec.decode(encoded, vocabulary)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(d, t or "") for d, t in texts}
    short = {(d, t or "") for d, t in texts if len(t or "") < 4000}
    ids = {r.doc_id: list(r.ids) for r in encoded.collect()}
    for d, t in sorted(short, key=repr)[:60]:
        assert ids[d] == best_path(vocabulary, t), (d, t[:80])


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b ", "\n", "a\nb", "a \nb", "\na", "▁", " ▁▁ x", "日本 \U0001F600\tz",
                                  "a" * 700, "ab" * 500 + "é", "\u2028 zz", "x\x00y", "▁\n▁"])
def test_sentencepiece_texts(vocabulary, text):
    codec = sentencepiece_codec.Codec(vocabulary)
    ids = codec.encode(text)
    assert list(ids) == best_path(vocabulary, text)
    assert codec.decode(ids) == text
    codec.run = None                                        # streamed as one run
    codec.v.lines, lines = False, codec.v.lines
    assert list(codec.encode(text)) == list(ids)
    codec.v.lines = lines


def test_sentencepiece_commits_early():
    v = sentencepiece_codec.Vocabulary({"a": (0, -1.0), "ab": (1, -1.5), "b": (2, -1.0), "▁": (3, -1.0)}, list(range(10, 266)))
    codec = sentencepiece_codec.Codec(v)
    made = []
    codec._emit = lambda *a, f=codec._emit: (made.append(a[3]), f(*a))
    codec.search("ab" * 200)
    assert len(made) > 20


# ------------------------------------------------------------- quality rules
def test_quality_rules(docs):
    rows = [(r.doc_id, r.text or "", r.source or "") for r in docs.collect()]
    hosts, lines = defaultdict(set), defaultdict(set)
    key = lambda l: re.sub("[1-9]", "0", " ".join(WHITE.findall(l)).lower())  # noqa: E731,E741
    for _, t, h in rows:
        for line in filter(WHITE.search, t.split("\n")):
            hosts[h].add(t)
            lines[h, key(line)].add(t)
    often = {k for k, v in lines.items() if len(v) > 3 and len(v) > 0.01 * len(hosts[k[0]])}
    wanted = []
    for d, t, h in rows:
        w = WHITE.findall(t)
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        c = Counter(tri)
        rep = {j for i, x in enumerate(tri) if c[x] > 1 for j in range(i, i + 3)}
        ls = [x for x in t.split("\n") if WHITE.search(x)]
        gone = sum(len(WHITE.findall(x)) for x in ls if (h, key(x)) in often)
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        wanted.append({"doc_id": d, "n_words": len(w), "word_chars": sum(map(len, w)),
                       "n_symbols": sum(t.count(x) for x in "#*$%&|<>"), "n_dup_lines": len(ls) - len(set(ls)),
                       "n_repeat_words": len(rep), "base_failed": failed, "n_line_words": gone,
                       "kept": not failed and len(w) - gone >= 0.5 * len(w)})
    cols = list(wanted[0]) if wanted else ["doc_id"]
    expect(quality_rules.judge(docs, min_docs=3), wanted, *cols)
    clean = quality_rules.clean(docs, min_docs=3)
    assert clean.columns == docs.columns
    kept = Counter(w["doc_id"] for w in wanted if w["kept"])
    got = clean.collect()
    assert Counter(r.doc_id for r in got) == kept
    for r in got:
        assert not any((r.source or "", key(x)) in often for x in r.text.split("\n") if WHITE.search(x))


def test_lines_of_very_many_texts_go_whatever_the_share(llm):
    body = lambda i: " ".join(f"{chr(97 + i)}x{j}" for j in range(60))
    docs = llm.createDataFrame([(i, body(i) + ("\nfooter line" if i < 8 else ""), "h") for i in range(10)],
                               "doc_id long, text string, source string")
    removed = lambda **k: quality_rules.judge(docs, min_docs=3, share=0.9, **k).filter("n_line_words = 2").count()
    assert removed() == 0 and removed(most_docs=7) == 8 and removed(most_docs=8) == 0
    texts = [r.text for r in quality_rules.clean(docs, min_docs=3, share=0.9, most_docs=7).collect()]
    assert len(texts) == 10 and not any("footer" in t for t in texts)


# ------------------------------------------------------------- n-gram join
def sets_of(rows):
    out = []
    for d, t in rows:
        w = WHITE.findall(low(t))
        out.append((d, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5
                    else frozenset([tuple(w)] if w else [])))
    return out


def joined(rows):
    sets = sets_of(rows)
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, s) in enumerate(sets):
        for b, z in sets[:i]:
            if a is not None and b is not None and s and z and len(s) <= 1.25 * len(z) and len(z) <= 1.25 * len(s):
                k = len(s & z)
                if 100 * k >= 80 * (len(s) + len(z) - k):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return [{"doc_id": d, "n_shingles": len(s), "component_id": None if d is None else find(d)} for d, s in sets]


def test_ngram_join(docs):
    wanted = joined([(r.doc_id, r.text) for r in docs.collect()])
    expect(ngram_join.join(docs), wanted, "doc_id", "n_shingles", "component_id")


def test_ngram_join_drifting_group(llm):
    """A chain of ever further copies, and copies around one text that mostly do not link with each other."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    rows, w = [(0, " ".join(base))], list(base)
    for i in range(1, 25):
        w[rng.integers(150)] = f"c{i}"
        rows.append((i, " ".join(w)))
    for i in range(100, 160):
        x = list(base)
        for j in rng.choice(150, rng.integers(1, 7), replace=False):
            x[j] = f"n{i}_{j}"
        rows.append((i, " ".join(x)))
    df = llm.createDataFrame(rows, "doc_id long, text string")
    expect(ngram_join.join(df, block_bytes=9000), joined(rows), "doc_id", "n_shingles", "component_id")
    kept = ngram_join.keep_one(df)
    assert {r.doc_id for r in kept.collect()} == {r["component_id"] for r in joined(rows)}


def test_keep_one_row_of_a_component(llm):
    """Repeated rows, rows of one id with two texts, and texts without an id."""
    text = lambda k, n=90: " ".join(f"{k}{i}" for i in range(n))
    near = lambda k: " ".join([text(k, 88), "other"])
    top = (1 << 63) - 1
    rows = [(1, text("a"), "x"), (1, text("a"), "x"), (1, text("a"), "y"), (2, text("b"), "x"), (None, text("b"), "x"),
            (None, near("b"), "x"), (None, text("c"), "x"), (None, text("c"), "x"), (None, near("c"), "x"),
            (3, text("d"), "x"), (3, text("e"), "x"), (4, near("e"), "x"), (None, "", "x"), (None, None, "x"), (5, " ", "x"),
            (5, " ", "x"), (7, text("f"), None), (6, text("f"), "x"), (6, text("f"), "x")]
    names = lambda df: sorted(((r.doc_id, (r.text or "")[:2]) for r in df.collect()), key=repr)
    df = llm.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'clash' as node", "1 as n")
    got = ngram_join.keep_one(df)
    assert got.columns == df.columns
    wanted = [(1, "a0"), (2, "b0"), (None, "c0"), (5, " "), (5, " "), (6, "f0"), (None, ""), (None, "")]
    assert [x for x in names(got) if x[0] != 3] == sorted(wanted, key=repr)
    assert [r.doc_id for r in got.collect()].count(3) == 1
    assert ngram_join.keep_one(df.limit(0)).count() == 0
    high = ngram_join.keep_one(df.union(llm.createDataFrame([(top, text("g"), "x", "clash", 1)], df.schema)))
    assert [x for x in names(high) if x[0] == top] == [(top, "g0")] and high.count() == 10
    assert names(ngram_join.keep_one(df.filter("doc_id is null"))) == sorted(
        [(None, "b0"), (None, "c0"), (None, ""), (None, "")], key=repr)


def test_signatures_are_shared_by_linked_sets():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        x = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
        y = x.copy()
        k = int(rng.integers(0, n // 9 + 1))
        y[rng.choice(n, k, replace=False)] = rng.choice(1 << 62, k, replace=False).astype(np.uint64)
        y = y[:n - int(rng.integers(0, n // 20 + 1))]
        x, y = np.sort(x), np.unique(y)
        common = np.intersect1d(x, y)
        if 100 * len(common) < 80 * (len(x) + len(y) - len(common)) or len(y) < 2 or n == len(common) == len(y):
            continue
        frequent = np.sort(rng.choice(common, int(rng.integers(0, len(common) + 1)), replace=False))
        a, b = (ngram_join.signatures_of(common, np.isin(common, frequent), len(z)) for z in (x, y))
        assert len(np.intersect1d(a, b)), (len(x), len(y), len(common), len(frequent))


def test_components(llm):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_components_extended(llm):
    links = lambda pairs: llm.createDataFrame(pairs, "a long, b long")
    known = components.components(links([(5, 4), (9, 8), (3, 2)]))
    got = components.extended(known, links([(5, 9), (8, 1), (7, 6), (2, 3)]))
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 2), (3, 2), (4, 1), (5, 1), (6, 6), (7, 6), (8, 1), (9, 1)]
    same = components.extended(known, links([]))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, known.collect()))


# ------------------------------------------------------------- license scan
def test_license_scan(llm, docs):
    classes = [(n, ALNUM.findall(low(t))) for n, t in license_scan.TEMPLATES]
    wanted = []
    for r in docs.collect():
        w, found = ALNUM.findall(low(r.text)), set()
        for name, t in classes:
            k = min(5, len(t))
            shingles = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
            mine = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            size = len(shingles)
            for i in range(0, len(mine), size):
                if 100 * len(shingles & set(mine[i:i + 2 * size])) >= 80 * size:
                    found.add(name)
        wanted.append({"doc_id": r.doc_id, "n_templates": len(found), "templates": ",".join(sorted(found))})
    expect(license_scan.scan(docs), wanted, "doc_id", "n_templates", "templates")


def test_license_texts_and_notices(llm):
    """Whole texts with changed words, notices in other wordings, and licences that must not be taken for each other."""
    rng = np.random.default_rng(4)
    texts = {n: t for n, t in license_scan.TEMPLATES if n.endswith("-text")}
    assert len(texts) >= 15

    def edited(text, share):
        w = text.split()
        for k in rng.choice(len(w), int(share * len(w)), replace=False):
            w[k] = f"edit{k}"
        return "before this " * 30 + " ".join(w) + " and after" * 40
    header = ("you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software "
              "Foundation; either version {} of the License, or (at your option) any later version.")
    cases = [(edited(t, 0.02), {n}) for n, t in texts.items()]
    cases += [(header.format(k, v), {n}) for k, v, n in [
        ("General Public License", "2", "gpl-2.0-header"), ("General Public License", "3", "gpl-3.0-header"),
        ("Lesser General Public License", "2.1", "lgpl-2.1-header"), ("Affero General Public License", "3", "agpl-3.0-header")]]
    cases += [("Released under an MIT License", {"mit"}), ("It is licensed under CC BY 4.0.", {"cc-by-4.0"}),
              ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", {"cc-by-sa-4.0"}),
              ("licensed under the Mozilla Public License, version 2.0", {"mpl-2.0"}),
              ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2.0"}),
              ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"})]
    none = ["Licensed under the Apache License, Version 1.1", "Released under the BSD License", edited(texts["gpl-2-text"], 0.3)]
    rows = list(enumerate([t for t, _ in cases] + none))
    got = {r.doc_id: set(r.templates.split(",")) for r in license_scan.scan(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, wanted) in enumerate(cases):
        assert wanted <= got[i], (wanted, got[i], text[:80])
    exact = range(len(texts), len(cases))
    assert [got[i] for i in exact] == [cases[i][1] for i in exact]
    assert [got[len(cases) + i] for i in range(len(none))] == [{""}] * len(none)


def test_license_band_numbers():
    for c in license_scan.classes_of(license_scan.TEMPLATES):
        jaccard = c.need / (3 * c.size - c.need)
        assert (1 - jaccard) ** c.bands <= license_scan.MISS * 1.0001


# ------------------------------------------------------------- chat formatting
HARD = ["", "plain", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\s>", "a\nb\n", "<<s>>",
        "[[INST]]", "<", "tail <|im_end|", "\\", "é<|im_start|>", "$1\\2", None]


def test_chat_round_trip(llm):
    rows = [(i // 4, i % 4, ["user", "assistant", "sys\ntem\\", "<|im_end|>"][i % 4], t) for i, t in enumerate(HARD * 4)]
    rows += [(None, 0, None, "x"), (7, None, "user", "null turn"), (7, 1, "user", "tie"), (7, 1, "user", "tie")]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as level", "1 as rendered")
    formatted = chat_format.conversations(df)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.read_back(formatted).collect()}
    wanted = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted[c].append((role or "", text or ""))
    assert got == dict(wanted)
    for r in chat_format.digest(formatted).collect():
        turns = wanted[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    plain = chat_format.render_turns(df.filter("text = 'plain' and role = 'user'")).first()
    assert (plain["level"], plain["rendered"]) == (0, "<|im_start|>user\nplain<|im_end|>\n")
    assert chat_format.conversations(df.limit(0)).count() == 0


# ------------------------------------------------------------- URL filters
def test_url_rules_and_reputation(llm):
    urls = [(0, None), (1, "no scheme"), (2, "http://WWW.Example.com/en/1?x#y"), (3, "https://a.example.com/en/"),
            (4, "x://example.com"), (5, "x://notexample.com/en/"), (6, "h://a.net/es/?q"), (7, "h://a.net?/es/"),
            (8, "h://a.net#://b.com/"), (9, "h://x.org/p"), (10, "h://x.org/p"), (None, "h://x.org/"), (11, "")]
    urls += [(i, "h://bad.org/p") for i in range(100, 160)]
    pages = llm.createDataFrame(urls, "page_id long, url string").selectExpr("*", "1 as host", "2 as n", "3 as bad")
    labels = llm.createDataFrame([(i, True) for i in range(100, 160)] + [(9, False), (9, None), (500, True)], "page_id long, bad boolean")
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    got = {r.page_id: r for r in url_filter.judge(pages, labels, rules).collect()}
    assert (got[0].host, got[0].path, got[0].rule) == ("", "", None)
    assert (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[3].rule, got[3].verdict) == ("example.com/en/", "block")
    assert (got[4].rule, got[5].rule) == (None, "com/")
    assert (got[6].rule, got[7].rule, got[8].host) == ("net/es/", None, "a.net")
    assert {got[i].verdict for i in range(100, 160)} == {"block"}
    # one labelled suffix, domains of which one has labels of each kind, hosts alone in their domains
    rate, low = 60.5 / 62, url_filter.STRENGTHS[0]
    suffix = (60 + 10 * rate) / 71
    domain = (0 + low * suffix) / (1 + low)                    # bad.org and x.org differ as much as can be
    mean = (0 + 10 * domain) / 11
    assert got[9].bad_mean == pytest.approx(mean) and got[9].verdict == "allow"
    assert got[100].bad_above > 0.999999
    assert len(got) == len({p for p, _ in urls})
    assert {r.verdict for r in url_filter.judge(pages, labels.limit(0), []).collect()} == {"allow"}


def test_share_of_a_beta_distribution(llm):
    """For whole a and b the share is a sum of binomial terms."""
    from pyspark.sql import functions as F
    cases = [(a, b) for a in (1, 2, 5, 40, 700) for b in (1, 3, 30, 900)]
    df = llm.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    for limit in (0.5, 0.2):
        got = df.select("a", "b", url_filter.share_above(F.col("a"), F.col("b"), limit).alias("s")).collect()
        for r in got:
            n = int(r.a + r.b) - 1
            term = [math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(limit)
                             + (n - j) * math.log(1 - limit)) for j in range(int(r.a))]
            assert r.s == pytest.approx(math.fsum(term), abs=2e-5), (r, limit)
    # fractions: against a fine sum of the density
    t = (np.arange(2_000_000) + 0.5) / 2_000_000
    for a, b in ((0.6, 0.7), (0.9, 4.2), (30.5, 0.8)):
        p = t ** (a - 1) * (1 - t) ** (b - 1)
        got = llm.createDataFrame([(a, b)], "a double, b double").select(url_filter.share_above(F.col("a"), F.col("b"), 0.5)).first()[0]
        assert got == pytest.approx(p[t > 0.5].sum() / p.sum(), abs=2e-3)


def test_strength_is_estimated_from_the_outcomes(llm):
    """Hosts drawn from beta distributions of a known strength, two domains."""
    rng = np.random.default_rng(8)
    for worth in (3.0, 60.0):
        rows = [(d, 200.0, float(rng.binomial(200, rng.beta(worth * m, worth * (1 - m))))) for d, m in (("a", 0.3), ("b", 0.7))
                for _ in range(800)]
        df = llm.createDataFrame(rows, "domain string, n double, bad double")
        got = llm.range(1).select(url_filter._strength(df, "domain")).first()[0]
        assert 0.8 * worth < got < 1.25 * worth
    same = llm.createDataFrame([("a", 100.0, 50.0)] * 50, "domain string, n double, bad double")
    assert llm.range(1).select(url_filter._strength(same, "domain")).first()[0] == pytest.approx(url_filter.STRENGTHS[1])
    assert llm.range(1).select(url_filter._strength(same.limit(1), "domain")).first()[0] == url_filter.STRENGTH
    assert llm.range(1).select(url_filter._strength(same.limit(0), "domain")).first()[0] == url_filter.STRENGTH


# ------------------------------------------------------------- suffix dedup
def deduped(rows, t=400):
    count = Counter()
    for _, b in rows:
        count.update(b[i:i + t] for i in range(len(b) - t + 1))
    out = []
    for d, b in rows:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - t + 1):
            if count[b[i:i + t]] > 1:
                cover[i] += 1
                cover[i + t] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append({"doc_id": d, "n_bytes": len(b), "n_removed": int(gone.sum()),
                    "n_spans": int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()),
                    "kept_sha256": hashlib.sha256(kept).hexdigest()})
    return out


COLS8 = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_suffix_dedup(docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    expect(suffix_dedup.report(docs), deduped(rows), *COLS8)
    left = suffix_dedup.remove(docs)
    assert left.columns == docs.columns and left.count() == len(rows)


def test_suffix_dedup_of_shorter_strings(docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    expect(suffix_dedup.report(docs, length=250), deduped(rows, 250), *COLS8)


def test_suffix_dedup_edits(llm):
    """Copies with single changes, periodic texts, overlapping repeats, matches
    of 399 and 400 bytes, and texts cut into pieces."""
    rng = np.random.default_rng(2)
    text = lambda n: "".join(rng.choice(list("abcdef é"), n))
    base = text(2500)
    docs = [base, base, "ab" * 900, "q" * 1000, text(100) + base[100:499] + text(50), text(60) + base[700:1100] + "Z"]
    for _ in range(12):
        x = list(base)
        for j in rng.choice(len(x), rng.integers(1, 6), replace=False):
            x[j] = "#"
        docs.append("".join(x))
    docs += [base[300:900] + base[1500:2200], text(9000) + base[:500] + text(700)]
    rows = list(enumerate(docs))
    df = llm.createDataFrame(rows, "doc_id long, text string")
    for length in (400, 150, 1000):
        wanted = deduped([(d, t.encode()) for d, t in rows], length)
        expect(suffix_dedup.report(df, length=length), wanted, *COLS8)
    with pytest.raises(ValueError):
        suffix_dedup.report(df, length=100)


def test_suffix_dedup_follows_equal_rows_once(llm, monkeypatch):
    """Rows that are equal in all columns count each other and are then one text."""
    rng = np.random.default_rng(3)
    text = lambda n: "".join(rng.choice(list("abcdef"), n))
    base = text(1500)
    near = base[:700] + "#" + base[701:]
    rows = [(1, base)] * 30 + [(2, near), (3, text(500) + base[200:650]), (4, text(900)), (5, "short")]
    stored, keep = {}, suffix_dedup._stored
    monkeypatch.setattr(suffix_dedup, "_stored", lambda df, label: stored.setdefault(label, keep(df, label)))
    expect(suffix_dedup.report(llm.createDataFrame(rows, "doc_id long, text string")),
           deduped([(d, t.encode()) for d, t in rows]), *COLS8)
    assert stored["texts"].count() == stored["texts"].select("key").distinct().count() == 3


def test_suffix_dedup_ranks_many_texts_at_once(monkeypatch):
    """Texts of a batch are hashed by slices of many texts, not one by one."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    made, ranks = [], suffix_dedup.Ranks
    monkeypatch.setattr(suffix_dedup, "Ranks", lambda buf: made.append(len(buf)) or ranks(buf))
    texts = ["".join(rng.choice(list("abcd"), n)) for n in (*range(400, 800, 8), 150_000)]
    runs = [[(0 << 20 | (len(t) - 400 & 1023) << 10 | 200) * suffix_dedup.FLAGS + suffix_dedup.OPEN] for t in texts[:-1]]
    runs.append([(140_000 << 20 | 9 << 10 | 30) * suffix_dedup.FLAGS + suffix_dedup.OPEN])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(runs)], ["key", "text", "runs"])
    out = pa.Table.from_batches(suffix_dedup._starts(400)([batch])).to_pandas()
    assert len(made) <= 3 and sum(made) == sum(map(len, texts))
    first = [range(len(t) - 399) for t in texts[:-1]] + [range(140_000, 140_010)]
    assert out.key.tolist() == [k for k, x in enumerate(first) for _ in x]
    place = out["at"].to_numpy() >> 20
    assert place.tolist() == [i for x in first for i in x]
    alone = bytesops.mix(suffix_dedup.R1.ranges(suffix_dedup.R1.byte_sums(np.frombuffer(texts[7].encode(), np.uint8)),
                                                np.array([5]), np.array([405])))
    assert out.rank1[(out.key == 7) & (place == 5)].tolist() == alone.view(np.int64).tolist()


# ------------------------------------------------------------- classifier
def test_quality_classifier(llm, edge, empty):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    trees = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs, trees)
    got = scored.join(labels, "doc_id").filter("held_out").toPandas()
    assert len(got) > 500
    assert (got.predicted == got.quality).mean() > 0.95
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    rows = quality_classifier.score(edge, trees).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = {r.doc_id: r.held_out for r in rows}
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in held.items() if d is not None) and not held[None]
    assert quality_classifier.score(empty, trees).count() == 0
    none = quality_classifier.train(edge, labels.limit(0))
    assert {r.score for r in quality_classifier.score(edge, none).collect()} == {0.5}


def test_statistics_fit_any_slicing(llm):
    texts = [r.text for r in llm.read.parquet(f"{SMALL}/documents.parquet").limit(40).collect()] + ["", None, " \n"]
    import pyarrow as pa
    one = np.vstack([quality_classifier.statistics(b, o) for _, _, b, o in bytesops.text_slices(pa.array(texts))])
    few = np.vstack([quality_classifier.statistics(b, o) for _, _, b, o in bytesops.text_slices(pa.array(texts), 500)])
    assert np.allclose(one, few)


# ------------------------------------------------------------- language model
@pytest.mark.parametrize("block_bytes, fan", [(1 << 24, 64), (20_000, 64), (20_000, 3)])
def test_lm_score(docs, block_bytes, fan):
    rows = [(r.doc_id, [*WHITE.findall(low(r.text)), "\0end"]) for r in docs.collect()]
    train = [d is None or zlib.crc32(str(d).encode()) % 5 != 1 for d, _ in rows]
    count, pairs, begins = Counter(), Counter(), sum(train)
    for (_, t), own in zip(rows, train, strict=True):
        if own:
            count.update(t)
            pairs.update(zip(["\0begin", *t[:-1]], t, strict=True))
    n, v = sum(count.values()), len(count)
    wanted = []
    after = Counter(a for a, _ in pairs)
    for (d, t), own in zip(rows, train, strict=True):
        base = score = 0.0
        for a, b in zip(["\0begin", *t[:-1]], t, strict=True):
            p = (count[b] + 0.5) / (n + 0.5 * (v + 1))
            seen = begins if a == "\0begin" else count[a]
            base += math.log10(p)
            score += math.log10((pairs[a, b] + after[a] * p) / (seen + after[a]) if seen else p)
        wanted.append([d, not own, len(t), sum(count[x] > 0 for x in t), n, round(base, 6), round(score, 6)])
    got = [[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)]
           for r in lm_score.score(docs, block_bytes=block_bytes, fan=fan).collect()]
    for a, b in zip(sorted(got, key=repr), sorted(wanted, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-4)


# ------------------------------------------------------------- queries
def test_every_query_is_registered():
    import __spark_entry__ as entry
    assert {int(m[1]) for m in map(re.compile(r"op(\d+)_").match, entry.queries()) if m} == set(range(1, 14))
    assert "pipeline" in entry.queries() and set(QUERIES) <= set(entry.queries())


# ------------------------------------------------------------- exchange
def exchanged(llm, blocks, fan, rng, keys=300):
    """Answers of an exchange of random keys, against a dictionary."""
    from portrait.llm import blocks as K
    pool = rng.integers(0, 1 << 63, 40 * blocks).astype(np.uint64) * np.uint64(2)
    held = [np.unique(rng.choice(pool, keys)) for _ in range(blocks)]
    counts = [rng.integers(0, 4, len(h)).astype(np.uint64) for h in held]
    ex = K.Exchange(blocks, fan)
    rows = [tuple(r[c] for c in ("kind", "g", "r", "child", "n", "keys", "counts"))
            for b in range(blocks) for r in ex.send(7, b, held[b], counts[b])]
    sent = llm.createDataFrame(rows, K.SENT)
    answers, sizes = ex.totals(sent)
    got = answers.toArrow()
    total, first = Counter(), {}
    for b in range(blocks):
        for k, c in zip(held[b].tolist(), counts[b].tolist(), strict=True):
            total[k] += c
            first.setdefault(k, b)
    for b in range(blocks):
        mine = got.filter((np.asarray(got["block"]) == b))
        value, own = K.received(mine, 7, len(held[b]))
        assert value.tolist() == [total[k] for k in held[b].tolist()]
        assert own.tolist() == [first[k] == b for k in held[b].tolist()]
    assert sizes.select("total", "present").collect() == [(sum(total.values()), sum(c > 0 for c in total.values()))]


@pytest.mark.parametrize("blocks, fan", [(1, 64), (5, 64), (9, 3), (30, 4)])
def test_exchange_adds_up_keys_of_all_blocks(llm, blocks, fan):
    exchanged(llm, blocks, fan, np.random.default_rng(blocks))


def test_messages_grow_like_the_bytes():
    """10, 40 and 160 blocks of equal size: messages a block stay within the fan at each level."""
    from portrait.llm import blocks as K
    rng = np.random.default_rng(2)
    per_block = {}
    for blocks in (10, 40, 160, 640):
        ex = K.Exchange(blocks, 8)
        keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
        level0 = ex.send(0, blocks - 1, keys, np.ones(len(keys)))
        assert len(level0) <= 8 and ex.f ** ex.levels >= blocks
        per_block[blocks] = len(level0) * ex.levels
    assert per_block[640] <= 2 * per_block[40] <= 4 * per_block[10]


def test_equal_rows_do_not_fill_one_block(llm):
    """Two thousand equal rows without id among four thousand: one stands for them, all get its result."""
    from portrait.llm import blocks as K
    text = " ".join(f"copy{i}" for i in range(60))
    rows = [(None, text)] * 2000 + [(i, f"own{i} " * 3 + " ".join(f"w{(i * j) % 997}" for j in range(50))) for i in range(2000)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    total = K.text_bytes(docs, docs["text"])
    small, everyone = K.copies(docs, total, 20_000)
    blocks = K.with_block(small, K.block_count(total, 20_000), "doc_id", "text")
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert small.count() == 2001 and max(sizes) < 60
    got = ngram_join.join(docs, block_bytes=20_000)
    assert got.count() == 4000 and got.filter("doc_id is null and n_shingles = 56").count() == 2000
    a = {r.doc_id: r.score for r in lm_score.score(docs, block_bytes=20_000).filter("doc_id is not null").collect()}
    b = {r.doc_id: r.score for r in lm_score.score(docs).filter("doc_id is not null").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)
    both = lm_score.score(docs, block_bytes=20_000).filter("doc_id is null").groupBy("score", "n_tokens").count().collect()
    assert [(r.n_tokens, r["count"]) for r in both] == [(61, 2000)]


def test_codecs_of_vocabularies_that_differ_in_one_piece():
    V = sentencepiece_codec.Vocabulary
    pieces = {f"p{i}": (i + 300, -float(i)) for i in range(200)}
    other = {(("q50") if p == "p50" else p): x for p, x in pieces.items()}
    a, b = V(pieces, list(range(256))), V(other, list(range(256)))
    assert sentencepiece_codec._codec(a).v is a and sentencepiece_codec._codec(b).v is b


def test_training_sample_holds_one_row_for_each_id(llm):
    docs = llm.createDataFrame([(i % 8, f"text {i} " * 20) for i in range(800)], "doc_id long, text string")
    labels = llm.createDataFrame([(i, i % 2) for i in range(8)] * 3, "doc_id long, quality int")
    x, y = quality_classifier.training_matrix(docs, labels, "quality", 4, 3, 1)
    usable = [i for i in range(8) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(x) == len(y) == min(4, len(usable)) > 0


def test_keep_one_leaves_helper_names_alone(llm):
    text = " ".join(f"w{i}" for i in range(40))
    cols = ["node", "NODE_", "lost", "again", "digest", "__node"]
    rows = [(1, text, *["mine"] * 6), (2, text, *["mine"] * 6), (None, text + " more", *["mine"] * 6)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in cols))
    got = ngram_join.keep_one(docs).collect()
    assert [(r.doc_id, *[r[c] for c in cols]) for r in got] == [(1, *["mine"] * 6)]
