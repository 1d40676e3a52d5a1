"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from carelake.llm import chat, decontam, exact, lines, mixing, neardup, quality, suffixes, tokens, urls
from carelake.llm.components import components
from carelake.session import scratch_path
from tests.llm import brute

RND = random.Random(9)
VOCAB = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


ODD = [(None, None, None), (None, "null id", "a"), (1, None, "a"), (2, "", "b"), (3, " \t\n ", "b"), (4, "one", None),
       (5, prose(400, 1), "a"), (6, prose(400, 1), "a"), (6, prose(400, 1), "a"), (7, prose(30_000, 2), "c"),
       (8, "é ü 中 🙂 " + prose(20, 3), "c"), (9, "two words", "é")]


# -- mixing ------------------------------------------------------------------------------

def test_mix_odd_rows(docs_of):
    got = mixing.mix(docs_of(ODD))
    assert "component" in got.columns and got.columns.count("size") == 1
    rows = got.collect()
    assert len(rows) == len(ODD)
    total = {}
    for r in rows:
        assert r.taken <= 2 * r["size"]
        total.setdefault(r.source, [0, r.target, 0])
        total[r.source][0] += r.taken
        total[r.source][2] += 1
    for taken, target, n in total.values():
        assert abs(taken - target) <= n + 1
    assert sum(t for _, t, _ in total.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs_of(ODD)).collect()))


def test_mix_ties_share(docs_of):
    got = mixing.mix(docs_of([(1, "a b c d", "s")] * 5 + [(2, "a b", "s")])).collect()
    assert abs(sum(r.taken for r in got) - got[0].target) <= 6
    assert len({r.taken for r in got if r.doc_id == 1}) == 1


def test_mix_empty(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert [r.taken for r in mixing.mix(docs_of([(1, None, None), (2, "", "x")])).collect()] == [0, 0]


# -- urls --------------------------------------------------------------------------------

def judge(spark, rows):
    df = spark.createDataFrame([(i, u, h, "mine", "own") for i, (u, h) in enumerate(rows)],
                               "page_id long, url string, html string, verdict string, rules string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}


def test_url_rules(spark):
    got = judge(spark, [("http://A.Example.ORG/es/x?q#f", None), ("https://example.org/en/17", ""), ("x://org?a/b", ""),
                        ("http://a.com/de/", ""), ("http://a.com/DE/", ""), (None, None), ("no scheme", ""), ("http://notorg/", ""),
                        ("http://example.org/es", "")])
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[2] == ("org", "", None, "allow")
    assert got[3][2:] == ("com/de/", "block") and got[4][2:] == (None, "allow")
    assert got[5] == ("", "", None, "allow") == got[6]
    assert got[7][2:] == (None, "allow") and got[8][2:] == ("org/", "allow")


def test_url_aliases(spark):
    canon = '<html><LINK href="%s" rel=canonical></html>'
    fresh = "<meta http-equiv='refresh' content='0; url=%s'>"
    got = judge(spark, [
        ("http://a.net/1", canon % "http://b.net/2"), ("http://b.net/2", fresh % "http://x.com/de/1"),   # blocked at the far end
        ("http://c.net/1", fresh % "http://x.com/de/2"), ("http://d.net/1", canon % "http://c.net/1"),
        ("http://c.net/2", canon % "http://x.com/de/3"), ("http://x.com/fr/1", canon % "http://c.net/2"),  # an allow goes first
        ("http://e.net/1", canon % "/2"), ("http://e.net/2", canon % "http://e.net/2"), ("http://c.net/1", None)])
    assert [got[i][3] for i in range(9)] == ["block", "block", "block", "block", "allow", "allow", "allow", "allow", "block"]


def test_url_targets_resolved(spark):
    """Every page but those that name no url of x.com/de/ is an alias of a blocked one."""
    canon, fresh = "<link rel=%s href='%s'>", '<meta http-equiv=refresh content="0; url=%s">'
    cases = [("http://x.com/de/a/1", ""), ("http://x.com/a/2", fresh % "../de/z"), ("http://x.com/b/3?u=/c/", fresh % "./../de/./y"),
             ("http://h.net/d/p", fresh % "page2.html"), ("http://h.net/d/page2.html", canon % ("canonical", "//x.com/de/1")),
             ("http://h.net/q?id=2", fresh % "?id=3&amp;n=1"), ("HTTP://H.net/q?id=3&n=1#top", canon % ('"nofollow canonical"', "http://X.COM/de/2#f")),
             ("http://h.net", fresh % "root"), ("http://H.NET/e/../root", canon % ("'canonical nofollow'", "http://x.com/fr/../de/3")),
             ("http://h.net/base", "<base href='/f/'>" + fresh % "g"), ("http://h.net/f/g", fresh % "http://x.com/de/4"),
             ("http://h.net/login", fresh % "/go?next=http://x.com/de/5"), ("http://h.net/go?next=http://x.com/de/5", ""),
             ("http://h.net/m", canon % ("canonical", "mailto:x@x.com")), ("http://h.net/n", canon % ("canonicals", "http://x.com/de/6")),
             ("http://h.net/o", fresh % "#de"), ("http://h.net/Root", ""), ("http://h.net/r", "<base href='http://x.com/de/'><link rel=canonical>")]
    got = judge(spark, [("http://w.net/", None)] + cases)
    assert [i for i, r in sorted(got.items()) if r[3] == "block"] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]


def test_url_tags_as_a_browser_sees_them(spark):
    bad = "http://x.com/de/"
    unseen = [f"<!-- <link rel=canonical href='{bad}1'> -->", f"<script>var x = \"<link rel=canonical href='{bad}2'>\"</script>",
              f"<!-- <b> <meta http-equiv=refresh content='0;url={bad}3'>", f"<title><link rel=canonical href='{bad}4'></title>",
              f"<link rel=canonical data-href='{bad}5' href='http://ok.net/1'>", f"<meta data-http-equiv=refresh content='0;url={bad}6'>",
              f"<meta http-equiv=refresh content='5'><!-- {bad} -->"]
    seen = [f"<!-- a --><link rel=canonical href='{bad}1'>", f"<link rel=canonical data-href='http://ok.net/2' href='{bad}2'>",
            f"<meta http-equiv=refresh content=\"0;{bad}3\">", f"<meta content='3, {bad}4' http-equiv=\"Refresh\">",
            f"<meta http-equiv=refresh content=\"0; URL='{bad}5'\">", f"<link rel=canonical href=' {bad}a b '>", f"<meta http-equiv=refresh content=0;url={bad}7>",
            f"<script src=x></script><base data-href='http://ok.net/' href='{bad}'><link rel=canonical href=8>", f"<meta http-equiv=refresh content='0 {bad}9'>"]
    rows = [(f"http://u.net/{i}", h) for i, h in enumerate(unseen)] + [(f"http://s.net/{i}", h) for i, h in enumerate(seen)]
    rows += [("http://t.net/", "<link rel=canonical href='/a b'>"), ("http://t.net/a%20b", f"<link rel=canonical href={bad}1>")]
    got = judge(spark, rows)
    assert [rows[i][0] for i, r in sorted(got.items()) if r[3] == "block"] == [u for u, _ in rows if "u.net" not in u]


def test_url_classes_by_brute_force(spark):
    """Random link graphs: the closure of block and allow over connected pages."""
    r = random.Random(12)
    hosts = ["a.net", "b.net", "x.com", "example.org"]
    urls_ = [f"http://{r.choice(hosts)}/{r.choice(['de/', 'fr/', 'p/', 'es/', ''])}{i}" for i in range(160)]
    forms = ["<link rel=canonical href='%s'>", '<meta http-equiv="refresh" content="1; url=%s">', "<meta http-equiv=refresh content='0;%s'>"]
    edges = [(i, r.randrange(200)) for i in range(160) for _ in range(r.choice([0, 0, 0, 1, 1, 2]))]
    at = lambda i: urls_[i] if i < 160 else f"http://{hosts[i % 4]}/{['de', 'q'][i % 2]}/far{i}"  # noqa: E731   beyond 160: no page of its own
    html = ["".join(r.choice(forms) % at(v) for u, v in edges if u == i) for i in range(160)]
    up = list(range(200))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for u, v in edges:
        up[root(u)] = root(v)

    def own(url):
        host, _, path = url[7:].partition("/")
        fit = [(len(k), k, v) for k, v in urls.RULES if ("." + host).endswith("." + k.partition("/")[0]) and ("/" + path).startswith("/" + k.partition("/")[2])]
        return max(fit)[2] if fit else None
    classes = {}
    for i in range(200):
        classes.setdefault(root(i), set()).add(own(at(i)))
    want = [own(u) or ("block" if classes[root(i)] >= {"block"} and "allow" not in classes[root(i)] else "allow") for i, u in enumerate(urls_)]
    got = judge(spark, list(zip(urls_, html)))
    assert [got[i][3] for i in range(160)] == want
    assert 5 < sum(w == "block" and own(u) is None for w, u in zip(want, urls_))


def test_urls_empty(spark):
    assert judge(spark, []) == {}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 70), (7, 7), (None, 3)] + [(200, x) for x in range(201, 260)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in range(41)) and got[70] == got[100] == 50 and got[259] == 200
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# -- tokens ------------------------------------------------------------------------------

def test_tokens_odd_texts(spark, docs_of):
    import public_tokenizers
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["", " ", "  a  b ", "▁▁ x▁y", "<s>hi</s>", "<0x0A>\n\r\n", "a" * 3000, "\x00�", "the" * 400 + "é" * 300,
             "".join(chr(c) for c in range(1, 0x500)), "中文 字" * 50, "🙂" * 20, "ab" * 129]
    r = random.Random(4)
    texts += ["".join(r.choice("aeinorst  hdl\n\té▁中<>s/0x.,'\"AB") for _ in range(r.randint(0, 90))) for _ in range(300)]
    rows = ODD + [(100 + i, t, "s") for i, t in enumerate(texts)]
    got = tokens.count_tokens(docs_of(rows), limit=10).collect()
    want = [(i, len((t or "").encode()), len(lib.encode(t or ""))) for i, t, _ in rows]
    assert sorted(((r[0], r[1], r[2]) for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 10) for r in got)
    assert tokens.count_tokens(docs_of([])).collect() == []


# -- lines -------------------------------------------------------------------------------

def test_lines_by_brute_force(docs_of):
    r = random.Random(6)
    pool = [prose(r.randint(1, 14), 50 + i) for i in range(40)] + ["", "  ", "x"]
    rows = [(i, "\n".join(r.choice(pool) + r.choice(["", " ", "\r"]) for _ in range(r.randint(0, 30))), "s") for i in range(60)]
    rows += [(100, "\n".join(pool), "s"), (101, "\n".join(pool[::-1]), "s"), (102, "\n".join(["a b c"] * 50), "s"),
             (103, None, "s"), (104, "", "s"), (105, prose(80, 3), None), (106, "y\n" + prose(80, 3), None)]
    for words in (1, 12, 30):
        got = lines.line_dedup(docs_of(rows), words)
        assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "key" in got.columns
        found = got.collect()
        assert {x.doc_id: x.text for x in found} == brute.line_cut([x[:2] for x in rows], words)
        assert all(x.n_runs <= x.n_removed <= x.n_lines for x in found)


def test_lines_odd_rows(docs_of):
    got = lines.line_dedup(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    assert [r.text for r in got if r.doc_id == 6] == ["", ""]                # rows of one text are cut alike
    assert {r.text for r in got if r.doc_id == 5} == {prose(400, 1)}
    assert lines.line_dedup(docs_of([])).collect() == []


def test_whole_runs_by_brute_force(docs_of):
    """A run goes with the lines behind its last window, at a document's end and before other lines."""
    r = random.Random(7)
    pool = [prose(r.choice([1, 2, 5, 9, 14, 40]), 350 + i) for i in range(30)] + ["", " \t"]
    rows = [(i, "\n".join(r.choice(pool) + r.choice(["", " ", "\r"]) for _ in range(r.randint(0, 14))), "s") for i in range(40)]
    long, short, tail = prose(100, 400), prose(8, 401), [prose(1, 402 + i) for i in range(29)]
    rows += [(100, f"{long}\n{short}", "s"), (101, f"{long}\n{short}", "s"), (102, f"a\n{long}\n\n{short} \nb c", "s"),
             (103, "\n".join([long] + tail), "s"), (104, "\n".join([long] + tail), "s"), (105, "\n".join([long] + tail[:9] + ["z"]), "s"),
             (106, f"{short}\n{long}", "s"), (107, "\n".join(["a b c"] * 50), "s"), (108, None, "s"), (109, "", "s"), (110, short, None)]
    for words in (1, 12, 30):
        got = lines.line_dedup(docs_of(rows), words, extend=True).collect()
        assert {x.doc_id: x.text for x in got} == brute.whole_line_cut([x[:2] for x in rows], words)
        assert all(x.n_runs <= x.n_removed <= x.n_lines for x in got)
    assert {x.doc_id: x.text for x in got}[101] == "" and {x.doc_id: x.text for x in got}[102] == "a\nb c"
    assert lines.line_dedup(docs_of([]), extend=True).collect() == []


# -- near duplicates ---------------------------------------------------------------------

def vary(text, share, seed):
    r, w = random.Random(seed), text.split()
    return " ".join(r.choice(VOCAB) if r.random() < share else x for x in w)


def test_item_of_50_mb(docs_of, spark):
    """One item much larger than a block: its windows go by blocks, its text stays with the tasks."""
    r = random.Random(3)
    words = [f"{r.getrandbits(320):080x}" for _ in range(640_000)]
    bench = spark.createDataFrame([("big", " ".join(words)), ("small", "one two three")], "item_id string, text string")
    assert bench.first().text.__len__() > 50_000_000
    docs = [(1, "x " + " ".join(words[600_000:600_025]) + " y", "s"), (2, " ".join(words[5:14]), "s"), (3, "One, two: three!", "s")]
    got = {x.doc_id: (x.n_hit, x["items"]) for x in decontam.decontaminate(docs_of(docs), bench).collect()}
    assert got == {1: (25, ["big"]), 2: (0, []), 3: (3, ["small"])}


def test_near_by_brute_force(docs_of):
    rows = [(i, vary(prose(120, i // 12), 0.0125 * (i % 12) / 2, i), "s") for i in range(120)]
    rows += [(500 + i, t, "s") for i, t in enumerate(["", None, "a", "A", "a b", "b a", "a b c", " A  b\tc", "x y z w", "x y z w x y z w"])]
    rows += [(600 + i, prose(120, 1), "s") for i in range(6)]
    for k, sim in ((3, (85, 100)), (5, (80, 100))):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_dup(docs_of(rows), k, sim).collect()}
        assert got == brute.near([x[:2] for x in rows], k, *sim)


def test_near_bands_follow_the_similarity(docs_of, monkeypatch):
    """A pair at the threshold shares no band with a chance of 4.4e-7 at most, also at the default similarity."""
    used = []
    plain = neardup.features
    monkeypatch.setattr(neardup, "features", lambda docs, k, bands, rows: used.append((bands, rows)) or plain(docs, k, bands, rows))
    rows = docs_of([(1, "a b c d e f", "s"), (2, "a b c d e f", "s")])
    for similarity, got in (((80, 100), neardup.near_dup(rows)), ((85, 100), neardup.near_dup(rows, 3, (85, 100)))):
        bands, per = used.pop(0)
        assert (1 - (similarity[0] / similarity[1]) ** per) ** bands <= 4.4e-7
        assert {r.component_id for r in got.collect()} == {1}
    assert neardup.bands_for((85, 100)) == neardup.bands_for((1, 1)) == 25


def test_near_rest_in_blocks(spark, docs_of, monkeypatch):
    """Chains that no pivot sees whole, and no star at all: the rest finds every link."""
    rows = [(i, vary(prose(100, i // 20), 0.02, i), "s") for i in range(60)]
    words = prose(600, 77).split()
    rows += [(100 + i, " ".join(words[4 * i:4 * i + 100]), "s") for i in range(40)]
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    want = brute.near([x[:2] for x in rows], 3, 85, 100)
    for stars in (True, False):
        if not stars:
            monkeypatch.setattr(neardup, "similar_signatures", lambda pairs, signs, least: pairs.filter("false"))
            monkeypatch.setattr(neardup, "spokes_of", lambda members: members.select(
                F.lit(-1).cast("long").alias("pivot"), "doc_id", "n_shingles").distinct())
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_dup(docs_of(rows), 3, (85, 100)).collect()}
        assert got == want


def test_near_odd_rows(docs_of):
    got = neardup.near_dup(docs_of(ODD)).collect()
    assert len(got) == len(ODD)
    assert {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert all(r.kept for r in got if r.doc_id in (1, 2, 3)) and {r.n_shingles for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert neardup.near_dup(docs_of([])).collect() == []


# -- exact -------------------------------------------------------------------------------

def test_exact_odd_rows(docs_of):
    rows = ODD + [(20, "ÉA b", "s"), (21, "Éa B", "s"), (22, "éa b", "s")]
    got = exact.exact_dedup(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text_sha256): r for r in got}
    sha = lambda t: hashlib.sha256(brute.lower(t).encode()).hexdigest()
    assert by[(20, sha("ÉA b"))].keep_id == 21 and by[(22, sha("éa b"))].kept
    empty = [r for r in got if r.text_sha256 == sha("")]
    assert {r.keep_id for r in empty} == {2} and {r.group_size for r in empty} == {3}
    assert sorted(r.kept for r in got if r.doc_id == 6) == [False, True] and not by[(5, sha(prose(400, 1)))].kept
    assert exact.exact_dedup(docs_of([])).collect() == []


def test_one_row_of_each_text_stays(docs_of):
    rows = [(3, "x", "s")] * 4 + [(1, "x", "s"), (None, "X", "s")] + [(None, "y", "s")] * 3 + [(7, None, "s"), (7, "", "s"), (7, "z", "s")]
    got = exact.exact_dedup(docs_of(rows)).collect()
    assert len(got) == len(rows)
    kept = sorted(((r.doc_id, r.group_size) for r in got if r.kept), key=str)
    assert kept == sorted([(3, 6), (None, 3), (7, 2), (7, 1)], key=str)
    assert all((r.doc_id == r.keep_id) for r in got if r.kept)


def test_index_persists_over_batches(spark, docs_of):
    path = scratch_path(spark, "test-index")
    first, second = exact.DigestIndex(spark, path, buckets=8), exact.DigestIndex(spark, path, buckets=8, name="opened_again")
    kept = lambda rows, index: sorted((r.doc_id, r.text_sha256[:3], r.keep_id, r.group_size) for r in
                                      exact.exact_dedup(docs_of([(i, t, "") for i, t in rows]), index).collect() if r.kept)
    a, b, c = (hashlib.sha256(x).hexdigest()[:3] for x in (b"a", b"b", b"c"))
    one = [(1, "a"), (2, "A"), (3, "b")]
    assert kept(one, first) == [(2, a, 2, 2), (3, b, 3, 1)]
    assert kept([(4, "a"), (5, "c"), (6, "c"), (9, "B")], second) == [(6, c, 6, 2)]
    assert kept(one, first) == [(2, a, 2, 2), (3, b, 3, 1)]                 # done again after a crash
    assert sorted(r.keep_id for r in first.seen().collect()) == [2, 3, 6]
    batch = exact.reduce_batch(docs_of([(7, "d", "")]).select("doc_id", exact.digest(F.col("text")).alias("digest"), F.lit(0).alias("row")))
    for df in (second.unseen(batch), second.answer(batch)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        # two exchanges, of the batch: for its aggregate and for the join; the index is only sorted
        index_side = [x for x in plan.split("\n") if "Sort [" in x or "Exchange" in x or "opened_again" in x][-2:]
        assert plan.count("Exchange") == 2 and "Sort [" in index_side[0] and "opened_again" in index_side[1]
    for index in (first, second):
        index.drop()
    assert not spark.catalog.tableExists("opened_again")


def test_buckets_grow_with_the_index(spark):
    assert exact.buckets_for(spark, 0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert exact.buckets_for(spark, 10**10) == -(-10**12 // (128 << 20))


# -- benchmark passages ------------------------------------------------------------------

def leak_case():
    items = [(1, prose(40, 1)), (2, prose(12, 2)), (3, "only four words here"), (4, ""), (5, None), (None, prose(15, 7)),
             (2, prose(14, 8)), (6, prose(10, 9))]
    docs = [(i, vary(prose(60, 100 + i) + " " + prose(40, 1)[i:i + 90] + " ! " + prose(12, 2) + "--" + prose(9, i), 0.02, i), "s")
            for i in range(40)]
    docs += [(50, "only FOUR, words\nhere", "s"), (51, prose(10, 9), "s"), (52, prose(15, 7).upper() * 2, "s"), (53, "only four", "s")]
    return docs, items


def test_leaks_by_brute_force(spark, docs_of):
    docs, items = leak_case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontam.BLOCK_WINDOWS, 20):                            # one block of windows, and many
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"])
               for r in decontam.decontaminate(docs_of(docs), bench, block_windows=limit).collect()}
        assert got == brute.leaks([d[:2] for d in docs], items, 10)


def test_proximity(spark, docs_of):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = docs_of([(1, "alpha beta x gamma delta", "s"), (2, "beta alpha gamma delta", "s"), (3, "alpha x y z beta gamma delta", "s"),
                    (4, "alpha beta gamma delta", "s")])
    hit = lambda slop: {r.doc_id for r in decontam.decontaminate(docs, bench, slop=slop).filter("contaminated").collect()}
    assert hit(0) == {4} and hit(1) == {1, 4} and hit(2) == {1, 2, 4}


def test_leaks_odd_rows(spark, docs_of):
    bench = spark.createDataFrame([(1, prose(400, 1))], "item_id long, text string")
    got = decontam.decontaminate(docs_of(ODD), bench).collect()
    assert len(got) == len(ODD) and sorted(r.doc_id for r in got if r.contaminated) == [5, 6, 6]
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontam.decontaminate(docs_of(ODD), none).collect())
    assert decontam.decontaminate(docs_of([]), bench).collect() == []


# -- chat --------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    hard = ["", "\\", "\\\\", "###", "####", "\\###", "### User: </turn>\n", "</turn", "<</turn>>", " </turn>\n### Assistant: x",
            "a\\", "\n", "🙂\\🙂", "\\@", ": ", None, "$1 \\1", "x" * 50_000]
    roles = ["user", "assistant", "system", "tool", "User", "\\@x", ": a", "", "###", None, "x: y </turn>"]
    rows = [(c, t, roles[(c + t) % len(roles)], hard[(c * 7 + t) % len(hard)]) for c in range(12) for t in range(9)]
    rows += [(99, None, "user", "late"), (99, 1, "user", "early"), (None, 0, "user", "no id"), (98, 0, "user", "b"), (98, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit("clash"))
    got = chat.format_chats(df).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    found = {r.conv_id: r for r in got.collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert found.keys() == want.keys()
    for c, turns in want.items():
        assert [tuple(x) for x in found[c].back] == turns
        assert found[c].loss == "".join(t for r, t in turns if r == "assistant")
        assert found[c].formatted == "".join(s.text for s in found[c].segments)


def test_chat_machine(spark):
    cases = {1: ("u", True, None), 2: ("suaua", True, None), 3: ("ua", True, None), 4: ("au", False, 0), 5: ("uu", False, 1),
             6: ("sa", False, 1), 7: ("uas", False, 2), 8: ("ut", False, 1)}
    name = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    rows = [(c, i, name[x], "t") for c, (seq, _, _) in cases.items() for i, x in enumerate(seq)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.conv_id: (r.valid, r.error_turn) for r in got} == {c: v[1:] for c, v in cases.items()}
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


# -- repeated bytes ----------------------------------------------------------------------

def byte_case():
    r = random.Random(8)
    base = [prose(r.randint(5, 60), 200 + i) for i in range(15)] + ["ab" * 90, "é" * 70, "x" * 49, "y" * 50, "\x00" * 80, "z\x00" * 30]
    docs = [(i, " ".join(r.choice(base)[r.randint(0, 9):] for _ in range(r.randint(0, 5))), "s") for i in range(50)]
    return docs + [(None, base[0], "s"), (None, base[0], "s"), (60, None, "s"), (60, base[0], "s"), (60, base[0], "s"), (61, "", "s")]


@pytest.mark.parametrize("shard,bucket,merge", [(1 << 21, 1 << 24, 1 << 20), (900, 700, 400), (1, 10_000, 1 << 20)])
def test_repeated_by_brute_force(docs_of, monkeypatch, shard, bucket, merge):
    rows = byte_case()
    monkeypatch.setattr(suffixes, "MERGE_BYTES", merge)
    got = [tuple(r) for r in suffixes.repeated_bytes(docs_of(rows), shard_bytes=shard, bucket_bytes=bucket).collect()]
    assert sorted(got, key=str) == sorted(brute.repeated([x[:2] for x in rows], 50), key=str)


def test_repeated_odd_rows(docs_of):
    got = [tuple(r) for r in suffixes.repeated_bytes(docs_of(ODD)).collect()]
    assert sorted(got, key=str) == sorted(brute.repeated([x[:2] for x in ODD], 50), key=str)
    assert suffixes.repeated_bytes(docs_of([])).collect() == []


def test_repeated_tasks_follow_the_data(docs_of, spark):
    """A bucket is a task of its own, and the shards' texts are not moved by the joins on shard."""
    from pyspark.sql import functions as F
    buckets, tasks = 9, 6
    shards = suffixes.pack_shards(docs_of(byte_case()), 900, tasks)
    answers = suffixes.answer_anchors(suffixes.send_anchors(shards, buckets, 50, 24), buckets)
    place = answers.select("bucket", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r.p for r in place}) == len({r.bucket for r in place}) == len(place) > 5
    marks = suffixes.mark_in_shards(shards, answers, tasks, buckets, 50, 24)
    plan = marks._jdf.queryExecution().executedPlan().toString()
    left = plan[:plan.index("ObjectHashAggregate")] if "ObjectHashAggregate" in plan else plan[:plan.index("Aggregate")]
    assert "text_shards" in left and "Exchange" not in left
    out = suffixes.cut_shards(shards, suffixes.mark_across(marks.filter("bucket >= 0"), buckets, 50), tasks, False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Aggregate")]


def test_suffix_array_and_prefixes():
    import numpy as np
    r = random.Random(2)
    for _ in range(40):
        base = bytes(r.choice(b"ab") for _ in range(r.randint(1, 200)))
        t = b"".join(base[r.randint(0, len(base) - 1):][:r.randint(1, 120)] for _ in range(r.randint(1, 20)))
        order, tied = suffixes.suffix_array(np.frombuffer(t, np.uint8), 50)
        assert all(t[a:a + 64] <= t[b:b + 64] for a, b in zip(order, order[1:]))

        def shared(a, b):
            h = 0
            while h < 50 and max(a, b) + h < len(t) and t[a + h] == t[b + h]:
                h += 1
            return h
        got = suffixes.common_prefixes(np.frombuffer(t, np.uint8), order, tied, 50)
        assert got.tolist() == [0] + [shared(a, b) for a, b in zip(order.tolist(), order.tolist()[1:])]


# -- quality -----------------------------------------------------------------------------

def test_quality_odd_rows(spark, docs_of):
    rows = ODD + [(100 + i, prose(50, i) if i % 2 else prose(50, i).upper() + " !!! ###", "s") for i in range(300)]
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(300)] + [(5, None, 0), (None, 1, 0), (9999, 1, 0), (101, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs_of(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.doc_id % 2) for r in got if r.doc_id and r.doc_id >= 100)
    assert [tuple(r) for r in quality.quality_scores(docs_of(rows), labels).collect()] == [tuple(r) for r in got]
    kept = quality.keep_good(docs_of(rows), labels)
    assert kept.columns == docs_of(rows).columns and "score" in kept.columns
    good = sorted(str(r.doc_id) for r in got if r.predicted)
    assert sorted(str(r.doc_id) for r in kept.collect()) == good
    assert quality.quality_scores(docs_of([]), labels).collect() == []


def test_quality_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.quality_scores(docs_of(ODD), none).collect()} == {1}
    zeros = spark.createDataFrame([(i, 0, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.quality_scores(docs_of(ODD), zeros).collect()} == {0}


def test_one_of_each_group(docs_of):
    """Shared and null ids: neither copies nor texts of their own are lost or doubled."""
    w, u = prose(80, 900), prose(80, 901)
    near = w + " x"
    left = lambda rows: sorted(((r.doc_id, r.text) for r in neardup.one_of_each(docs_of(rows)).collect()), key=str)
    assert left([(3, w, "s"), (3, w, "s"), (None, w, "s"), (None, w, "s"), (4, w, "s")]) == [(3, w)]
    assert left([(5, w, "s"), (7, w, "s"), (7, u, "s")]) == [(5, w), (7, u)]
    assert left([(None, w, "s"), (None, near, "s"), (None, u, "s")]) in ([(None, w), (None, u)], [(None, near), (None, u)],
                                                                         sorted([(None, w), (None, u)], key=str), sorted([(None, near), (None, u)], key=str))
    assert left([(9, w, "s"), (2, u, "s"), (2, near, "s"), (2, near, "s"), (-4, "", "s"), (-4, "", "s"), (-4, None, "s"), (None, None, "s")]) == sorted(
        [(2, u), (2, near), (-4, ""), (-4, None), (None, None)], key=str)
    many = [(i % 5, w, "s") for i in range(300)] + [(i, prose(40, 1000 + i), "s") for i in range(6, 20)]
    assert left(many) == sorted([(0, w)] + [(i, prose(40, 1000 + i)) for i in range(6, 20)], key=str)
    assert neardup.one_of_each(docs_of([])).collect() == []
    assert neardup.one_of_each(docs_of([(1, w, "s")])).columns == docs_of([]).columns


def test_lines_repeated_rows_are_one_per_task(docs_of):
    """Rows that share id and text meet before the shuffle."""
    plan = lines.line_windows(docs_of([(1, "a b\nc", "s")]).select("doc_id", "text"), 2)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange" in x]
    assert len(exchanges) == 1 and "Generate" in plan.split(exchanges[0])[0] and "partial_first" in plan.split(exchanges[0])[1]


def test_rules_as_a_column(spark):
    """The compiled expression scores like the rules evaluated one by one."""
    import numpy as np
    rng = np.random.default_rng(8)
    x = np.round(rng.random((600, 4)), 2)
    y = ((x[:, 0] > 0.6) & (x[:, 2] <= 0.5) | (x[:, 3] > 0.9)).astype(int)
    names = ["a", "b", "c", "d"]
    model = quality.RuleEnsemble.fit(names, x, y)
    assert len(model.rules) > 5
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double, c double, d double")
    got = dict(map(tuple, rows.select("i", model.column({n: F.col(n) for n in names}).alias("score")).collect()))
    for i, r in enumerate(x):
        total = model.bias + sum(w for rule, w in model.rules if all((r[f] > cut) == above for f, above, cut in rule))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)
    assert np.mean([(got[i] > 0.5) == y[i] for i in range(600)]) > 0.95


def test_sample_is_cut_before_it_is_sorted(spark, docs_of, monkeypatch):
    """The rows with the least hashes are learned from, repeated rows once, whatever the cut."""
    docs = docs_of([(i % 900, prose(3 + i % 900 % 7, i % 900), "s") for i in range(1800)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality.RuleEnsemble, "fit", staticmethod(lambda names, x, y: seen.append((x, y)) or quality.RuleEnsemble((), (), 0.0)))
    table, stats = quality.measured(docs, ["doc_id"])
    ids = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5]
    ranked = sorted(ids, key=lambda i: int(hashlib.md5(f"train:{i}".encode()).hexdigest()[:15], 16))
    for most in (37, 10_000):
        quality.learn(table, stats, labels, most)
        x, y = seen.pop()
        assert y.tolist() == [i % 2 for i in ranked[:most]]
        assert x[:, 0].tolist() == pytest.approx([float(math.log1p(3 + i % 7)) for i in ranked[:most]])
