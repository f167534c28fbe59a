"""Edge cases of the text operators: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import base64
import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from parceltide.llm import (
    decontaminate, html_text, line_dedup, mixing, quality_rules, secrets, simhash, simhash_similar, suffix_dedup, toxicity,
    url_filters,
)
from parceltide.llm.bwt_merge import merge, transform
from parceltide.llm.components import components
from pyspark.sql import functions as F

ODD = [(1, "a b"), (1, "a b"), (None, None), (None, "x"), (2, ""), (3, " \t\n"), (4, "é" * 300_000), (5, "word " * 60_000)]


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghilmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(words))


# -- shared structures


def test_merged_transform_equals_one_sort():
    rnd = np.random.default_rng(3)
    rows = rnd.integers(1, 4, (40, 12))
    rows[:, -1] = 0
    rows[7] = rows[21]
    shards = [transform(rows[i : i + 9]) for i in range(0, 40, 9)]
    for depth in (1, 3, 6):
        merged = merge(shards, 12, depth)
        around = np.concatenate((rows, rows), axis=1)
        prefix = [tuple(around[i, j : j + depth]) for i in range(40) for j in range(12)]
        by_interval = {}
        for k, p in zip(merged.interval.tolist(), prefix):
            by_interval.setdefault(k, set()).add(p)
        assert all(len(s) == 1 for s in by_interval.values()) and len(by_interval) == len(set(prefix))
        ordered = sorted(prefix)
        shared = [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(ordered, ordered[1:])]
        assert merged.common[1:].tolist() == shared


def test_components_chain_star_and_empty(llm):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = dict(components(llm.createDataFrame(links, "a long, b long")).collect())
    assert {found[k] for k in range(51)} == {0} and {found[k] for k in range(100, 140)} == {100}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


# -- 1 suffix dedup


def stretches(texts, length):
    seen = Counter()
    for t in texts:
        seen.update(t[k : k + length] for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("length,together", [(64, 20_000), (100, 20_000), (64, 2)])
def test_repeats_like_brute_force(llm, documents, length, together):
    rnd = random.Random(length + together)
    shared = [prose(k, rnd.randint(10, 50)) for k in range(6)]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            kind, s = rnd.random(), rnd.choice(shared)
            at = rnd.randint(0, len(s) // 2)
            parts.append(prose(rnd.random(), rnd.randint(1, 30)) if kind < 0.4 else s[at : at + rnd.randint(20, 300)] if kind < 0.85 else "aé" * rnd.randint(10, 80))
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], None, ""]
    rows = [(None if i == 5 else i, t) for i, t in enumerate(texts)]
    found = {(r.id, r.text): bytes(r.kept) for r in suffix_dedup.without_repeats(documents(rows), length=length, most_together=together).collect()}
    for (i, t), want in zip(rows, stretches([(t or "").encode() for t in texts], length)):
        assert found[i, t or ""] == want


def test_repeats_of_odd_rows(llm, documents):
    rows = suffix_dedup.without_repeats(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r.id: len(r.kept) for r in rows if r.id in (4, 5)} == {4: 0, 5: 0}  # both repeat within themselves
    assert suffix_dedup.without_repeats(documents([])).count() == 0


# -- 3 line dedup


def test_lines_stay_in_the_largest_document(llm, documents):
    line, other = "A line of more than twenty letters", "another line with enough letters"
    rows = [(1, f"{line}\nx\n  {line.upper()}"), (2, f"{line}\n{other}"), (3, f"{other}\n{line}\t\n{line}"), (3, f"{other}\n{line}\t\n{line}"), (None, line), (9, None), (8, "")]
    kept = line_dedup.with_bitmaps(documents(rows)).withColumn("out", line_dedup.kept_text("text", "_keep")).collect()
    assert [(r.doc_id, r.out, r._n_lines, r._n_dropped) for r in sorted(kept, key=lambda r: (r.doc_id or 0, r.out))] == [
        (None, "", 1, 1), (1, "x", 3, 2), (2, other, 2, 1), (3, f"{other}\n{line}\t\n{line}", 3, 0), (3, f"{other}\n{line}\t\n{line}", 3, 0), (8, "", 1, 0), (9, "", 1, 0)
    ]
    assert kept[0].lang == "en" and kept[0].id == 1
    one = next(r for r in kept if r.doc_id == 1)
    assert np.unpackbits(np.frombuffer(zlib.decompress(one._keep), np.uint8), count=3).tolist() == [0, 1, 0]


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_a_hot_line_over_many_ranges(llm, documents, ranges):
    line = "this line is found in every document"
    rows = [(i, f"{line}\nown line number {i} of this text\n{line if i % 3 else ''}") for i in range(60)]
    llm.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        gone = {(r.doc, r.pos) for r in line_dedup.dropped_lines(documents(rows)).collect()}
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", 4)
    assert gone == {(i, p) for i in range(59) for p in (0, 2) if p == 0 or i % 3}


def test_lines_of_an_empty_table(llm, documents):
    assert line_dedup.with_bitmaps(documents([])).count() == 0


# -- 4 URL filters


def test_url_rules(llm):
    urls = {
        "http://EXAMPLE.com/en/a": ("example.com", "/en/a", "example.com/en/", "block"),
        "http://www.example.com/en/a?x#y": ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        "http://a.b.com/": ("a.b.com", "/", "com/", "allow"),
        "http://xcom/": ("xcom", "/", None, "allow"),
        "http://b.com:80/en/": ("b.com:80", "/en/", None, "allow"),
        "https://m.casino-win.org/a": ("m.casino-win.org", "/a", None, "block"),
        "https://casinos.org/casino": ("casinos.org", "/casino", None, "allow"),
        "https://x.net/fr/": ("x.net", "/fr/", "net/fr/", "block"),
        "https://x.net/FR/": ("x.net", "/FR/", None, "allow"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "a://b://c.com/": ("b:", "//c.com/", None, "allow"),
    }
    pages = llm.createDataFrame([(i, u, "x") for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string")
    rows = url_filters.filter_pages(pages).collect()
    assert len(rows) == 2 * len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.url], r.url
    assert url_filters.filter_pages(pages.where("false")).count() == 0


def test_rules_without_a_literal_always_run(llm):
    pages = llm.createDataFrame([(1, "http://a.org/7"), (2, "http://a.org/x")], "page_id long, url string")
    rule = url_filters.PatternRule("block", "digit", "/[0-9]$", ())
    rows = {r.id: r.verdict for r in url_filters.filter_pages(pages, paths=(), patterns=(rule,)).collect()}
    assert rows == {1: "block", 2: "allow"}


# -- 5 decontamination


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_windows_hit_and_spans(llm, documents, most):
    item = "one two three four five six seven eight nine ten eleven"
    items = llm.createDataFrame([(10, item), (9, "tiny item"), (7, None), (6, "..."), (10, item)], "item_id long, text string")
    rows = [(1, f"zero, {item.upper()} -- twelve"), (2, "a TINY, item and tiny item"), (3, "tiny apart item"), (None, None), (4, "")]
    found = decontaminate.contamination(documents(rows), items, most_windows=most).withColumn("hit", decontaminate.n_hit_words()).collect()
    assert {r.id: (r.n_words, r.hit, sorted(r.item_ids)) for r in found} == {
        1: (13, 11, ["10"]), 2: (6, 4, ["9"]), 3: (3, 0, []), None: (0, 0, []), 4: (0, 0, [])
    }
    one = next(r for r in found if r.id == 1)
    assert one.text[one.span_starts[0] : one.span_ends[0]] == item.upper()
    kept = decontaminate.without_contaminated(documents(rows), items, most_windows=most)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4] and kept.columns == documents(rows).columns


def test_no_benchmark_hits_nothing(llm, documents):
    none = llm.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(ODD), none).where("size(item_ids) > 0").count() == 0
    assert decontaminate.contamination(documents([]), none).count() == 0


# -- 6 toxicity


def test_non_negative_risk_finds_the_marked_words():
    rnd = np.random.default_rng(1)
    settings = toxicity.Settings(slots=1024, least_documents=2)
    plain = [np.unique(rnd.integers(0, 900, 40)) for _ in range(900)]
    toxic = [np.union1d(np.unique(rnd.integers(0, 900, 40)), rnd.choice(np.arange(1000, 1010), 3)) for _ in range(200)]
    model = toxicity.fit_pu(toxic[:100], plain[:800] + toxic[100:150], 0.06, settings)
    score = lambda rows: np.array([model.weights[r].sum() + model.bias for r in rows])
    assert (score(toxic[150:]) > 0).mean() > 0.8 and (score(plain[800:]) > 0).mean() < 0.02


def test_toxicity_without_labels_or_rows(llm, documents):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(ODD), none)
    rows = toxicity.scores(documents(ODD), model).collect()
    assert len(rows) == len(ODD) and all(r.score < 1e-6 for r in rows)
    assert toxicity.without_toxic(documents(ODD), none).columns == documents(ODD).columns
    assert toxicity.scores(documents([]), model).count() == 0


# -- 7 secrets


def spans(llm, documents, text):
    row = secrets.secret_spans(documents([(1, text)])).select(
        secrets.listed(F.col("assign"), F.col("access"), F.col("hex"), F.col("entropy")).alias("s")
    ).first()
    return row.s


def test_secret_spans(llm, documents):
    assert spans(llm, documents, None) == spans(llm, documents, "") == ""
    assert spans(llm, documents, "é𝒳 api_key = 'abcdefghijkl'") == "assign:3:26"
    assert spans(llm, documents, "password=token = abcdefghijkl") == ""  # the short first match uses up the second key
    assert spans(llm, documents, "AKIAABCDEFGHIJKLMN xAKIAABC") == "access:0:18"
    assert spans(llm, documents, "z0123456789abcdefz") == "hex:1:17"
    key = "9fK2xQ7LmZ4tWv8RbY1cHj6N"
    assert spans(llm, documents, f"is {key} ok") == f"entropy:3:{3 + len(key)}"
    assert spans(llm, documents, "Abcdefghijklmnopqrstuvwxyz and under-the-long-dashed-name") == ""  # allow-listed


def test_window_entropy_like_brute_force(llm):
    rnd = random.Random(4)
    words = ["".join(rnd.choice(a) for _ in range(rnd.randint(20, 60))) for a in ("0123456789abcdef", "abAB12", "ABCdef0123456789+/xyzQRS") for _ in range(20)]
    kind = secrets.CLASSES[1]
    frame = llm.createDataFrame([(w,) for w in words], "w string").select("w", secrets.high_entropy_runs(F.col("w"), kind.alphabet, kind.least_bits).alias("runs"))
    for r in frame.collect():
        hit = np.zeros(len(r.w), bool)
        for k in range(len(r.w) - 19):
            counts = np.array(list(Counter(r.w[k : k + 20]).values()))
            if np.log2(20) - (counts * np.log2(counts)).sum() / 20 >= kind.least_bits - 1e-9:
                hit[k : k + 20] = True
        assert sum(x.end - x.start for x in r.runs) == hit.sum()


def test_secrets_of_odd_rows(llm, documents):
    assert secrets.secret_spans(documents(ODD)).count() == len(ODD)
    assert secrets.secret_spans(documents([])).count() == 0


# -- 8 SimHash


@pytest.mark.parametrize("together", [2, 1024])
def test_links_like_brute_force(llm, together):
    rnd = random.Random(8)
    centre = [rnd.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centre for _ in range(60)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    links = simhash.close_links(llm.createDataFrame([(p,) for p in prints], "fp long"), most_together=together).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(pairs):
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {p: find(p) for p in prints}

    got = dict(join((r.a, r.b) for r in links))
    for p in prints:
        root[p] = p
    want = join((a, b) for a in prints for b in prints if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    assert got == want
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= 64 for r in links)


def test_simhash_of_odd_rows(llm, documents):
    rows = simhash.near_duplicates(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    assert simhash.near_duplicates(documents([])).count() == 0


def test_similar_texts_keep_one(llm, documents):
    base = prose(1, 300).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in (20, 150, 280)]
    rows = [(5, " ".join(base)), (3, near[0]), (4, near[1]), (9, near[2]), (1, prose(2, 300)), (1, prose(2, 300)), (None, prose(3, 50)), (7, ""), (8, None)]
    kept = simhash_similar.keep_one(documents(rows))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 7] and kept.columns == documents(rows).columns
    tight = simhash_similar.keep_one(documents(rows), most_together=2)
    assert sorted(r.doc_id or 0 for r in tight.collect()) == [0, 1, 3, 7]
    assert simhash_similar.keep_one(documents([])).count() == 0


def jaccard_components(texts, similarity=0.8):
    """Smallest index of every text's component by exact Jaccard of five-word shingles, all pairs."""
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().split() for t in texts)]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and len(a & sets[j]) >= similarity * len(a | sets[j]) - 1e-9:
                low, high = sorted((label[i], label[j]))
                label = [low if c == high else c for c in label]
    return label


def edited(words, rnd, changes):
    words = list(words)
    for at in rnd.sample(range(len(words)), changes):
        words[at] = f"w{rnd.getrandbits(32)}"
    return " ".join(words)


@pytest.mark.parametrize("together", [2, 5, 1024])
def test_similar_texts_like_brute_force(llm, documents, together):
    """Edited copies around 0.8 with chains, crowded bands and texts near a hub, near each other or neither."""
    rnd = random.Random(31)
    texts = []
    for centre in range(3):
        base = prose(70 + centre, 120).split()
        texts += [edited(base, rnd, rnd.randint(0, 5)) for _ in range(25)]
        step = base
        for _ in range(6):
            step = edited(step, rnd, 2).split()
            texts.append(" ".join(step))
    found = {r.id: r.component for r in simhash_similar.similar_documents(documents(list(enumerate(texts))), most_together=together).collect()}
    want = jaccard_components(texts)
    assert len(set(want)) > 10
    smallest = {}
    for i in range(len(texts)):
        smallest.setdefault(found[i], i)
    assert [smallest[found[i]] for i in range(len(texts))] == want


def test_links_of_a_group_survive_a_borderline_member():
    """a and c are alike, b is near both but similar to neither; its place in the group must not matter."""
    a, c = np.arange(100, dtype=np.uint64), np.arange(9, 109, dtype=np.uint64)
    b = np.concatenate((np.arange(4, 92, dtype=np.uint64), np.arange(500, 530, dtype=np.uint64)))
    for order in ([a, b, c], [b, a, c], [a, c, b], [c, b, a]):
        edges = simhash_similar.forest(order, 0.8)
        assert len(edges) == 1 and all(order[k] is not b for k in edges[0])


def test_pairs_around_the_limit_are_decided_exactly(llm, documents):
    rnd = random.Random(8)
    texts = []
    for k in range(120):
        base = prose(1000 + k, 150).split()
        texts += [" ".join(base), edited(base, rnd, rnd.choice((1, 2, 3, 4, 5)))]
    found = {r.id: r.component for r in simhash_similar.similar_documents(documents(list(enumerate(texts)))).collect()}
    want = jaccard_components(texts)
    assert 30 < sum(want[2 * k] == want[2 * k + 1] for k in range(120)) < 110
    assert [found[2 * k] == found[2 * k + 1] for k in range(120)] == [want[2 * k] == want[2 * k + 1] for k in range(120)]


# -- 9 quality rules


def test_bands_reject_both_ends(llm, documents):
    rnd = random.Random(2)
    noise = "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(3000))
    rows = [(11, prose(1, 800)), (12, "same words again and again. " * 300), (13, noise), *ODD]
    found = {r.id: r for r in quality_rules.quality_verdicts(documents(rows)).collect()}
    assert found[11].band_ok and not found[12].band_ok and not found[13].band_ok and not found[5].band_ok
    assert found[5].n_words == 60_000 and found[2].ratio == 1.0
    assert quality_rules.quality_verdicts(documents([])).count() == 0


def test_noise_or_repeats_in_one_chunk_reject(llm, documents):
    noise = base64.b64encode(random.Random(5).randbytes(15_000)).decode()
    text = prose(4, 8000)
    rows = [
        (1, text[:40_000]), (2, noise[:20_000] + text[:20_000]), (3, text[:36_000] + noise[:4_000]),
        (4, text[:20_000] + "again and " * 800 + text[20_000:32_000]),
    ]
    found = {r.id: r for r in quality_rules.quality_verdicts(documents(rows)).collect()}
    assert {i: r.band_ok for i, r in found.items()} == {1: True, 2: False, 3: False, 4: False}
    assert found[1].n_chunks == 10 and found[1].n_bad_chunks == 0


# -- 10 HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar">
<header>Site name</header><nav><ul><li>Menu</li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp;
 more</h1><p>First <b>bold</b><br>line &lt;x&gt;.<div class="ad">Buy</div><p>Second&nbsp;one<form><input>Send</form>
<ul><li>A<li>B</ul><section id="comments"><p>Nice post</p></section></article><aside>More</aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Title & more\nFirst bold line <x>.\nSecond one\nA\nB"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<body><div>menu</div><p>plain body</p><footer>f") == "menu\nplain body"
    assert html_text.main_text("<article><p>cut <b>off") == "cut off"
    assert html_text.main_text("<nav><ul><li>never closed<article><p>body</p></article>") == "body"


def test_class_words_and_teasers_do_not_drop_the_body():
    body = "A long body of the page, sentence after sentence. " * 20
    for names in ('class="content with-sidebar"', 'id="search-page"', 'class="widget-area main-text"'):
        page = f"<body><div {names}><p>{body}</p><div class='share'>Share this</div></div><div class='sidebar'>More</div></body>"
        assert html_text.main_text(page) == body.strip()
    teaser = f"<body><article><p>A teaser</p></article><div><p>{body}</p></div></body>"
    assert body.strip() in html_text.main_text(teaser)


def test_surge_and_dive_points():
    how = html_text.Distribution(window=3, surge=0.5, dive=0.1)
    assert html_text.surge_and_dive(np.array([5, 0, 0, 0, 80, 60, 0, 70, 0, 0, 0, 9]), how) == [(4, 8)]
    assert html_text.surge_and_dive(np.array([], dtype=int), how) == html_text.surge_and_dive(np.zeros(4, int), how) == []
    rnd, how = random.Random(4), html_text.Distribution()
    for _ in range(300):
        lengths = [rnd.choice([0, 0, rnd.randint(1, 30), rnd.randint(50, 400)]) for _ in range(rnd.randint(1, 25))]
        sums = [sum(lengths[i : i + how.window]) for i in range(len(lengths))]
        want, inside = [], False
        for length, total in zip(lengths, sums):  # every line on its own
            inside = total > how.dive * max(sums) if inside else length > 0 and total >= how.surge * max(sums)
            want.append(inside)
        got = [False] * len(lengths)
        for first, last in html_text.surge_and_dive(np.array(lengths), how) if any(lengths) else []:
            got[first:last] = [True] * (last - first)
        assert got == (want if any(lengths) else got)


def test_plain_divs_are_decided_by_text_lengths():
    body = [f"Sentence {k} of a body that goes on for a while and says something." * 2 for k in range(8)]
    menu = "".join(f"<div><a href='/{k}'>{k}</a></div>" for k in ("Home", "Products", "About", "Imprint"))
    page = f"<body><div>{menu}</div><div>Top</div><br>" + "".join(f"<div>{b}</div>" for b in body)
    page += "<div>Buy</div><div><a href='p'>Privacy</a></div><div>(c) me</div></body>"
    got = html_text.main_text(page).split("\n")
    assert [x for x in got if x in body] == body and not {"Home", "Products", "About", "Imprint", "Privacy", "(c) me"} & set(got)


def test_hostile_pages_take_linear_time():
    for piece in ('<a b="', "<a ", "<a b='", "<!", "<script ", "<script></script ", "<div>", "<b></i>", "<nav><article></article>", "<p class='ad'>x</p>"):
        for end in ("", ">", '">', "'>"):
            start = time.process_time()
            html_text.main_text(piece * (1_000_000 // len(piece)) + end)
            assert time.process_time() - start < 4, (piece, end)
    assert html_text.main_text('<p>one</p><a b="x<p>two</p><i c=">three</i><p>four</p>"') == 'one\nthree\nfour\n"'


def test_pages_of_odd_rows(llm):
    pages = llm.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t")], "page_id long, url string, html string, text string")
    assert html_text.extract_pages(pages).count() == 3
    assert html_text.extract_pages(pages.where("false")).count() == 0


# -- 2 mixing


def test_mixing_limits_and_rounds(llm, documents):
    rows = [(i, prose(i, 50), "big") for i in range(90)] + [(100 + i, prose(100 + i, 50), "small") for i in range(10)] + [(200, None, "none"), (201, "a", None)]
    all_kept = mixing.mixed_rows(documents(rows), mixing.Mix(entropy=0.9, most_repeats=2.0, keep_all=True)).collect()
    times = Counter(r.doc_id for r in all_kept)
    assert set(times) == {r[0] for r in rows} and max(times.values()) == 2 and times[0] == 1
    some = mixing.mixed_rows(documents(rows), mixing.Mix(entropy=1.0, budget=1500.0)).collect()
    tokens = Counter()
    for r in some:
        tokens[r.source] += 50 if r.doc_id < 200 else 1
    assert 500 <= tokens["big"] <= 550 and 500 <= tokens["small"] <= 550
    again = mixing.mixed_rows(documents(rows), mixing.Mix(entropy=1.0, budget=1500.0)).collect()
    assert sorted(map(str, some)) == sorted(map(str, again))
    assert mixing.mixed_rows(documents([]), mixing.Mix(entropy=0.9)).count() == 0


def test_mixing_counts_equal_rows_one_by_one(llm, documents):
    ten = "w " * 10
    rows = [(7, ten, "a")] * 50
    read = mixing.mixed_rows(documents(rows), mixing.Mix(budget=50.0)).collect()
    assert len(read) == 5 and {r.doc_id for r in read} == {7}
    again = mixing.mixed_rows(documents(rows), mixing.Mix(budget=1_230.0)).collect()  # two rounds and 23 more
    assert len(again) == 123 and Counter(r.mix_round for r in again) == {0: 50, 1: 50, 2: 23}
    none = mixing.mixed_rows(documents([(i, None, "empty") for i in range(40)] + rows), mixing.Mix(block_rows=10)).collect()
    assert Counter(r.source for r in none) == {"empty": 40, "a": 50} and len({r.mix_block for r in none if r.source == "empty"}) > 1


def test_mixing_equals_brute_force(llm, documents):
    rows = [(i, "w " * (i % 9), f"s{i % 3}") for i in range(60)] + [(3, "w w w ", "s0")] * 7
    how = mixing.Mix(entropy=0.99, budget=700.0, block_tokens=40)
    got = mixing.mixed_rows(documents(rows), how)
    # the order of reading, from the operator's own blocks and the hashes it sorts by
    order = got.select(
        "source", "doc_id", "mix_round", "mix_weight", mixing.token_count(F.col("text")).alias("tokens"),
        F.xxhash64(F.lit(how.seed), "mix_block").alias("turn"),
        F.xxhash64(F.lit(how.seed + 1), F.xxhash64("doc_id", "text")).alias("place"),
    ).collect()
    have = Counter((i, s) for i, _, s in rows)
    for source in ("s0", "s1", "s2"):
        read = sorted((r for r in order if r.source == source and r.tokens), key=lambda r: (r.mix_round, r.turn, r.place))
        budget = np.ceil(round(read[0].mix_weight * 700, 6))
        before = np.cumsum([0] + [r.tokens for r in read])[:-1]
        assert (before < budget).all() and before[-1] + read[-1].tokens >= budget
        for rnd in range(read[-1].mix_round):  # every round but the last is whole
            assert Counter(r.doc_id for r in read if r.mix_round == rnd) == {
                i: n for (i, s), n in have.items() if s == source and i % 9}


def test_clashing_and_odd_column_names(llm, documents, tmp_path):
    line = "a line that many texts repeat"
    docs = documents([(i, f"{prose(i, 30)}\n{line}", "a") for i in range(4)])
    odd = docs.selectExpr("*", "1 AS rounds", "2 AS mix_block", "3 AS key", "4 AS `row`", "5 AS _row", "6 AS _doc", "7 AS _gone",
                          "8 AS `a-b`", "9 AS `a b`", "10 AS `all`", "11 AS hash", "12 AS _keep")
    mixed = mixing.mixed_rows(odd, mixing.Mix(entropy=0.9)).collect()
    assert len(mixed) == 4 and all((r.rounds, r.key, r["a-b"], r["a b"], r.hash) == (1, 3, 8, 9, 11) for r in mixed)
    lined = line_dedup.with_bitmaps(odd).collect()
    assert sorted(r._n_dropped for r in lined) == [0, 1, 1, 1] and all((r._row, r._doc, r._gone, r["all"]) == (5, 6, 7, 10) for r in lined)
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.without_toxic(odd, labels).columns == odd.columns and toxicity.without_toxic(odd, labels).count() == 4


def test_exponent_by_bisection(llm):
    shares = llm.createDataFrame([("a", 800, 0.8), ("b", 150, 0.15), ("c", 50, 0.05)], "source string, tokens long, share double")
    a = mixing.find_exponent(shares, mixing.Mix(entropy=0.9))
    p = np.array([0.8, 0.15, 0.05]) ** a
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() - 0.9 * np.log(3)) < 1e-6
    a = mixing.find_exponent(shares, mixing.Mix(entropy=0.9, most_repeats=2.0))
    p = np.array([0.8, 0.15, 0.05]) ** a
    assert abs((p / p.sum() / [0.8, 0.15, 0.05]).max() - 2) < 1e-5


# -- pipeline


def test_pipeline_on_planted_cases(llm, documents, tmp_path):
    clean = [(i, prose(i, 200), f"s{i % 3}") for i in range(40)]
    item, line = prose(900, 30), "a licence line that many texts repeat"
    planted = [(100, clean[0][1], "s0"), (101, clean[1][1] + " tail", "s1"), (102, f"{prose(50, 80)} {item} {prose(51, 80)}", "s2")]
    lined = [(110 + k, f"{prose(60 + k, 100)}\n{line}", "s0") for k in range(3)]
    documents(clean + planted + lined).drop("id").write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = corpus_pipeline.run(llm, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {i for i, *_ in clean} | {110, 111, 112}
    assert {r.doc_id for r in rows if line in r.text} == {112}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"]


def test_digest_of_items():
    assert decontaminate.digest(["1", "2"]) == hashlib.sha256(b"1,2").hexdigest()


def test_the_pipeline_drops_what_simhash_links(llm, documents):
    """Equal fingerprints of different texts: letters in another case, and one changed word in a long text."""
    words = [f"w{k}" for k in range(400)]
    other = words[:200] + ["x"] + words[201:]
    rows = [(5, " ".join(words)), (3, " ".join(words).upper()), (9, " ".join(other)), (1, "a b c d e f g"), (2, None), (4, " ")]
    rows += [(k, " ".join(f"{k}v{j * (k + 3) % 101}" for j in range(30))) for k in range(20, 24)]
    edited = " ".join("1 2 3 4 5 6 7 8".split() + ["y"])
    rows += [(30, "1 2 3 4 5 6 7 8"), (31, edited)]
    docs = documents(rows)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(llm, docs, "").collect()}
    linked = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    near = {r.id: r.component for r in simhash_similar.similar_documents(docs).collect()}
    groups = {k: {k} for k, _ in rows}
    for a, _ in rows:
        for b, _ in rows:
            if linked[a] == linked[b] or near[a] == near[b]:
                union = groups[a] | groups[b]
                for k in union:
                    groups[k] = union
    assert kept == {min(g) for g in groups.values()}
    assert len({linked[k] for k in (3, 5, 9)}) == 1
    # the same three-word shingles in another order: equal fingerprints, few five-word shingles in common
    one, two = (f"x y {' x y '.join(order)} x y" for order in ("abcdefghijkl", "acegikbdfhjl"))
    assert simhash._fingerprint(one.encode(), 3) == simhash._fingerprint(two.encode(), 3)
    pair = documents([(1, one), (2, two)])
    assert simhash_similar.keep_one(pair).count() == 2
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(llm, pair, "").collect()] == [1]


def test_texts_meet_python_in_small_chunks(spark):
    """A worker held arrays of two million numbers for chunks of a megabyte, and batches of up to 64 MB."""
    import pyarrow as pa
    from parceltide.llm import bytes_math
    from parceltide.session import prepare

    chunks = list(bytes_math.text_chunks(pa.array(["x" * 1000] * 1000)))
    assert len(chunks) > 3 and sum(len(texts) for _, texts in chunks) == 1000
    assert len(bytes_math._powers_for(1000)[0]) * 8 <= 4 << 20
    assert int(prepare(spark).conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
    texts, word = [b"one two", b"two " * 150_000], [(0, 3), (4, 7)]
    starts, ends = (bytes_math.np.array(k) for k in zip(*word))
    short = bytes_math.run_hashes(bytes_math.Joined(texts[:1]).buffer, starts, ends)
    long = bytes_math.run_hashes(bytes_math.Joined(texts).buffer, starts, ends)
    assert (short == long).all()  # whatever the length of the chunk
