"""Operators on awkward rows and small hand-made cases."""

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from hearthwatt.llm import bpe, fingerprint, frames, htmltext, linededup, packing, quality, simhash, toxicity, warc
from hearthwatt.llm.components import components
from hearthwatt.llm.frames import new_path
from hearthwatt.llm.neighbours import nearest
from hearthwatt.llm.queries import CODEC_RANKS, PACKING_RANKS, PACKING_TOKENIZER, table

LABELS = "doc_id long, quality int, toxic int"


def test_bpe_matches_on_odd_strings():
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(CODEC_RANKS), special_tokens={}
    )
    draw, letters = random.Random(3), "aab....!!- \n\t  erehte😀é²½½中文иил'sd1200==__\x1c\x85　"
    encoder = bpe.rank_encoder(CODEC_RANKS)
    for _ in range(2000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 20))) * draw.choice((1, 1, 4))
        ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert ids == encoding.encode_ordinary(text)
        assert bpe.decoded(ids, CODEC_RANKS).decode() == text


def test_bpe_round_trip(awkward, empty):
    encoded = bpe.bpe_encode(awkward, CODEC_RANKS)
    assert bpe.bpe_encode(empty, CODEC_RANKS).isEmpty()
    back = bpe.bpe_decode(encoded, CODEC_RANKS).select("text").collect()
    assert sorted(r[0] for r in back) == sorted((r[0] or "") for r in awkward.select("text").collect())
    ids = np.frombuffer(bpe.rank_encoder(CODEC_RANKS).encode(["é😀a"])[0], "<u4")
    start, end = bpe.offsets("é😀a", ids, CODEC_RANKS)
    assert start[0] == 0 and end[-1] == 3
    assert "".join(bpe.decoded_parts([[i] for i in ids.tolist()], CODEC_RANKS)) == "é😀a"


@pytest.mark.parametrize("seed", range(5))
def test_bins_hold_all_and_fit(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 300)
    found = packing.bins(lengths, 100)
    assert sorted(x for b in found for x in b) == sorted(lengths.tolist())
    assert max(map(sum, found)) <= 100
    assert len(found) <= -(-lengths.sum() // 100) + max(2, (lengths > 50).sum() // 4)


def test_the_smallest_gives_way_to_two():
    # Greedy 60 + 30 leaves 10; 25 + 15 in place of 30 fill the bin.
    assert packing.bins(np.array([60, 30, 25, 15]), 100)[0] == [60, 25, 15]


def test_packing_of_awkward_rows(awkward, empty):
    rows = packing.pack_documents(awkward, PACKING_TOKENIZER, PACKING_RANKS, capacity=64).collect()
    assert packing.pack_documents(empty, PACKING_TOKENIZER, PACKING_RANKS).isEmpty()
    assert sum(r["piece"] == 0 for r in rows) == awkward.count()
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]


def test_line_windows_of_awkward_rows(awkward, empty):
    assert linededup.dedup_lines(empty).isEmpty()
    found = linededup.dedup_lines(awkward)
    assert found.columns == [*awkward.columns, "lines_removed"]
    texts = {(r["doc_id"], r["text"], r["lines_removed"]) for r in found.collect()}
    # A null id is the smallest.
    assert (None, "no id\nfirst line of it\nsecond line of it\nthird line of it\nend", 0) in texts
    assert (1, "alpha beta\nomega", 3) in texts and (2, "gamma", 3) in texts
    assert (3, None, 0) in texts and (7, "\n\n\n\n", 0) in texts


def test_overlapping_windows_merge(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "b\nc")], "doc_id long, text string")
    texts = dict(linededup.dedup_lines(df).select("doc_id", "text").collect())
    assert texts == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "b\nc"}


def test_simhash_of_awkward_rows(awkward, empty):
    assert simhash.simhash_components(empty).isEmpty()
    rows = simhash.simhash_components(awkward).collect()
    zero = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert len(rows) == awkward.count() and zero == {3}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["label"] for r in rows if r["vertex"] < 100} == {1}
    assert {r["label"] for r in rows if r["vertex"] >= 100} == {100} and len(rows) == 100


def plain_segments(hits, cost, length):
    """Ruzzo and Tompa's definition: split at the best segment, again and again."""
    scores = [-cost] * length
    for place, score in hits:
        scores[place] = score

    def within(a, b):
        best = max(((sum(scores[i : j + 1]), i, j) for i in range(a, b) for j in range(i, b)), key=lambda x: (x[0], x[1] - x[2]), default=None)
        if best is None or best[0] <= 1e-12:
            return []
        return [*within(a, best[1]), best, *within(best[2] + 1, b)]

    return within(0, length)


@pytest.mark.parametrize("seed", range(30))
def test_segments_are_the_maximal_ones(seed):
    draw = random.Random(seed)
    length = draw.randint(1, 25)
    hits = [(i, draw.choice((0.7, 1.3, 2.1))) for i in range(length) if draw.random() < 0.4]
    found = toxicity.segments(hits, 0.61)
    plain = plain_segments(hits, 0.61, length)
    assert [(a, b) for _, a, b in found] == [(a, b) for _, a, b in plain]
    assert [s for s, _, _ in found] == pytest.approx([s for s, _, _ in plain])


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    none = spark.createDataFrame([], LABELS)
    model = toxicity.train_toxicity(awkward, none)
    rows = toxicity.score_toxicity(awkward, model).collect()
    assert len(rows) == awkward.count() and {r["score"] for r in rows} == {0.5}
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 1, 1), (6, 0, 1), (6, 0, 0)], LABELS)
    model = toxicity.train_toxicity(awkward, labels)
    assert toxicity.score_toxicity(empty, model).isEmpty()
    assert toxicity.score_toxicity(awkward, model).count() == awkward.count()


def test_quality_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (6, 0, 1)], LABELS)
    sites = (lambda: F.col("source"), lambda: F.col("lang"))
    rows = quality.score_quality(awkward, labels, *sites).collect()
    assert len(rows) == awkward.count() and all(0 < r["score"] < 1 for r in rows)
    assert quality.score_quality(empty, labels, *sites).isEmpty()


def test_warc_holds_any_payload(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb"
    rows = [(1, "http://a/ b\r\nX: y", trap), (2, None, trap), (3, "http://c/", "é😀"), (4, "http://d/", None), (5, None, ""), (None, None, "x"), (7, "u", "once")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_path(spark, "test-warc")
    warc.write_warc(pages.coalesce(1), path)
    found = {r["page_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert len(found) == 7
    assert bytes(found[2]["payload"]).decode() == trap and found[1]["refers_to"] == 2
    assert found[1]["payload_bytes"] == len(trap) and found[1]["payload_digest"] == found[2]["payload_digest"]
    assert (found[4]["record_type"], found[4]["refers_to"], found[5]["record_type"]) == ("revisit", 5, "response")
    assert found[None]["record_type"] == "response" and bytes(found[3]["payload"]).decode() == "é😀"
    assert {r["record_type"] for r in warc.warc_revisits(pages, min_bytes=1000).collect()} == {"response"}
    assert warc.warc_revisits(pages.limit(0)).isEmpty()


def test_warc_blocks_of_many_parts():
    """Payloads that hold what separates records, also at their ends; each part is read once."""
    separator = warc.RECORD_END + warc.VERSION
    blocks = [separator * 100_000 + "é", "", separator, "x" + warc.RECORD_END, "😀" + separator + "\r\n"]
    archive = warc.RECORD_END.join(f"{warc.VERSION}Content-Length: {len(b.encode())}{warc.RECORD_END}{b}" for b in blocks)
    parts = (archive + warc.RECORD_END).split(separator)
    assert [block for _, block in warc.records(iter(parts))] == blocks
    with pytest.raises(ValueError):
        list(warc.records(iter(parts[:10])))


def test_fingerprints_of_awkward_rows(awkward, empty):
    assert fingerprint.fingerprints_with_edits(empty).isEmpty()
    rows = fingerprint.fingerprints_with_edits(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {""}
    assert fingerprint.fingerprints(awkward).count() == awkward.count()
    only = fingerprint.fingerprints_with_edits(awkward.where("doc_id = 1")).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1.0


def test_nearest_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (20, [1.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [0.0, 0.0]), (120, [3.0, None]), (3, [2.0, 2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in sorted(nearest(df).collect()):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == {0: [(3, 2.0), (1, 1.0), (20, 1.0), (2, 0.0)], 20: [(3, 2.0), (0, 1.0), (1, 1.0), (2, 0.0)]}
    assert nearest(df.limit(0)).isEmpty()


def test_main_text_of_odd_pages(spark):
    page = """<body><header><h1>Site</h1></header><nav><a href=x>a</a></nav><div class="cookie-notice">Cookies, ok.</div>
    <div id="wrap"><div class="content"><h1>T &amp; x</h1><p>First, with commas,\n and text.<p>Second <a href=x>link</a> para
    <ul><li>one, two<li>three</ul><div class="comments"><p>nice, great, post</p></div><form><p>hi</p></form></div>
    <div class="sidebar"><p>foo, bar</p></div></div><footer>f</footer>"""
    text = "T & x\n\nFirst, with commas, and text.\n\nSecond link para\n\none, two\n\nthree"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>cut off &am"), (4, "u", "<nav>menu</nav>"), (5, "u", "<a title='")]
    found = htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in found] == [text, "", "", "cut off &am", "", ""]


def test_main_text_outside_short_articles():
    long = "A long sentence of the body, with commas, that goes on for quite a while, and then on. " * 3
    body = "".join(f"<p>{long}</p>" for _ in range(5))
    cards = "".join(f"<article><p>Card {k}, short.</p></article>" for k in range(3))
    page = f"<body><div><div>{body}</div></div><div>{cards}</div></body>"
    assert htmltext.main_text(page) == "\n\n".join([long.strip()] * 5)
    quoted = f"<body><article>{body}</article><blockquote>{long * 3}</blockquote><div>{cards}</div></body>"
    assert htmltext.main_text(quoted) == "\n\n".join([long.strip()] * 5 + [(long * 3).strip()])


# SimHash


def brute_close(prints):
    return {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def linked(pairs):
    label = {x: x for p in pairs for x in p}
    for a, b in pairs:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {x: new if y == old else y for x, y in label.items()}
    return label


@pytest.mark.parametrize("hot", [1, 3, 32])
def test_close_fingerprints_link_as_brute_force(spark, hot):
    """Random ones, chains, stars, and many that share one segment, for several limits of a hot value."""
    draw, prints = random.Random(hot), set()
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for _ in range(40):
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 8)):
            prints.add(signed(base))
            for bit in draw.sample(range(64), draw.randint(1, 3)):
                base ^= 1 << bit
    half = draw.getrandbits(32) << 32
    prints |= {signed(half | draw.getrandbits(6) << draw.choice((0, 13, 26))) for _ in range(200)}
    pairs = simhash.close_fingerprints(spark.createDataFrame([(p,) for p in prints], "fingerprint long"), hot).collect()
    found = {(r["a"], r["b"]) for r in pairs}
    close = brute_close(prints)
    assert found <= close and linked(found) == linked(close)
    if hot == 32:
        cold = {p for p in prints if p >> 32 != signed(half) >> 32}
        assert {p for p in found if set(p) <= cold} == brute_close(cold)


def test_fetched_fingerprints_may_fail_the_whole_distance(spark):
    """Equal in one segment and three bits apart in the other: fetched, and not linked."""
    df = spark.createDataFrame([(0b111,), (0,), (3 << 40,)], "fingerprint long")
    table, probes = simhash.segment_table(df), simhash.segment_probes(df)
    same = table.join(probes.withColumnRenamed("fingerprint", "other"), ["part", "value"]).where("fingerprint < other")
    assert {(r["fingerprint"], r["other"]) for r in same.collect()} >= {(0, 0b111)}
    assert {(r["a"], r["b"]) for r in simhash.close_fingerprints(df).collect()} == {(0, 3 << 40)}


# Fingerprints


def plain_anchors(text):
    k, s = fingerprint.K, fingerprint.S
    points = [0x110000 + i for i in range(k - 1)] + [ord(c) for c in text]

    def hashed(run):
        value = 0
        for x in run:
            value = (value * 0x9E3779B97F4A7C15 + x) % (1 << 64)
        return int(fingerprint._mixed(np.array([value], np.uint64))[0])

    out, count = [], len(points) - k + 1 if text else 0
    for i in range(count):
        inner = [hashed(points[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]) or i == count - 1:
            out.append((i - k + 1, hashed(points[i : i + k])))
    return out


@pytest.mark.parametrize("length", [0, 1, 2, 31, 32, 33, 127, 129, 500])
def test_anchors_equal_a_plain_loop(length):
    draw = random.Random(length)
    text = "".join(draw.choice("abcdefghij klmnop😀é") for _ in range(length))
    at, hashes = fingerprint.anchors(text)
    assert list(zip(at.tolist(), hashes.tolist(), strict=True)) == plain_anchors(text)
    assert fingerprint.positions(fingerprint.from_text(fingerprint.as_text(fingerprint.sketch(text)))).tolist() == at.tolist()


def test_syncmers_do_not_depend_on_their_surroundings():
    text = "the quick brown fox jumps over the lazy dog and runs far away from here. " * 4
    inner = dict(zip(*(x.tolist() for x in fingerprint.anchors(text)), strict=True))
    moved = dict(zip(*(x.tolist() for x in fingerprint.anchors("moved by so much: " + text)), strict=True))
    assert all(moved.get(place + 18) == value for place, value in inner.items() if place >= 0)


def test_anchors_are_matched_in_order():
    draw = random.Random(2)
    parts = ["".join(draw.choice("abcdefghij klmnop") for _ in range(600)) for _ in range(4)]
    whole, swapped = "".join(parts), "".join(parts[2:] + parts[:2])
    same = fingerprint.likeness(fingerprint.sketch(whole), fingerprint.sketch(whole))
    moved = fingerprint.likeness(fingerprint.sketch(whole), fingerprint.sketch(swapped))
    assert same == 1 and 0.25 < moved < 0.4  # only one half can be in order


def test_likeness_follows_from_the_fingerprints(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdefghij klmnop") for _ in range(n)) for n in (3, 127, 129, 1000)]
    rows = [(9, texts[1]), (8, texts[1] + "xy"), (7, texts[0]), (6, None), (5, texts[3]), (4, texts[3][:900]), (3, texts[2]), (None, texts[2])]
    found = fingerprint.fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = {r["doc_id"]: r for r in found}
    order = [d for d, _ in rows]
    for doc, following in zip(order, order[1:] + order[:1], strict=True):
        r, n = by_id[doc], by_id[following]
        own, edited, after = map(fingerprint.from_text, (r["fingerprint"], r["edited_fingerprint"], n["fingerprint"]))
        assert r["near_edited"] == fingerprint.likeness(own, edited) and r["near_next"] == fingerprint.likeness(own, after)
    assert by_id[9]["near_next"] > 0.7 and by_id[5]["near_next"] > 0.8 and by_id[3]["near_next"] == 1


@pytest.mark.parametrize("at_once", [1, 3, 1000])
def test_next_texts_across_ranges(spark, at_once):
    rows = [(i % 7 if i % 3 else None, f"text {i} " * 3) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = fingerprint.fingerprints_with_edits(df, documents_at_once=at_once).collect()
    copies = {r["text"]: r["copy"] for r in df.select("text", F.xxhash64("text").alias("copy")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), copies[r[1]]))
    expected = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        expected.append((str(doc), fingerprint.hashlib.sha256(fingerprint.edited_by_next(text, following).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in found) == sorted(expected)


# Main text


LONG = "A long sentence of the body, with commas, that goes on for quite a while, and then on. " * 3


def test_linked_lists_and_sections_of_an_article_stay():
    references = "<h2>References</h2><ul><li><a href=a>One title of a work</a></li><li><a href=b>Another title</a></li></ul>"
    related = f"<section class='related-work'><h2>Related work</h2><p>{LONG}</p></section>"
    outside = "<div class='related-posts'><p>See also, this</p></div><div class='comments-list'><p>Nice, thanks, all</p></div>"
    page = f"<body><ul><li><a href=c>Home</a><li><a href=d>News</a></ul><article><p>{LONG}</p>{related}{references}{outside}</article></body>"
    expected = [LONG.strip(), "Related work", LONG.strip(), "References", "One title of a work", "Another title"]
    assert htmltext.main_text(page) == "\n\n".join(expected)


def test_pages_with_several_and_no_articles():
    paragraphs = f"<p>{LONG}</p><p>{LONG}</p>"
    several = f"<body><article><h2>One</h2>{paragraphs}</article><article><h2>Two</h2>{paragraphs}</article></body>"
    assert htmltext.main_text(several) == "\n\n".join(["One", LONG.strip(), LONG.strip(), "Two", LONG.strip(), LONG.strip()])
    menu = "<ul><li><a href=a>Home</a></li><li><a href=b>About</a></li></ul>"
    assert htmltext.main_text(f"<body>{menu}{paragraphs}</body>") == "\n\n".join([LONG.strip()] * 2)
    assert htmltext.main_text("<p>a &lt<b>;</b> &amp; b</p>") == "a <; & b"


# Quality, toxicity


def test_sites_shrink_to_their_parents_without_the_own_label(spark):
    """Posteriors against plain numbers: all texts alike, so evidence is zero everywhere."""
    rows = [(i, "fine words here", "big" if i < 40 else "small", "p" if i % 2 else "q") for i in range(43)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    good = {i: float(i >= 40 or i % 4 > 0) for i in range(43)}
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in good.items()], LABELS)
    found = {r["doc_id"]: r for r in quality.score_quality(docs, labels, lambda: F.col("source"), lambda: F.col("lang")).collect()}
    out = [i for i, r in found.items() if r["held_out"]]
    assert out
    known = [good[i] for i in good if i not in out]
    share = (sum(known) + 1) / (len(known) + 2)
    own = {i: share if i in out else good[i] for i in good}
    place = {i: (r[2], r[3]) for i, r in enumerate(rows)}
    total, n = sum(own.values()), len(own)
    mean = (total + 0.5) / (n + 1)

    def sums(part):
        sites = {}
        for i in own:
            held = sites.setdefault(part(i), [0, 0.0])
            held[0], held[1] = held[0] + 1, held[1] + own[i]
        return sites

    def weight(sites, parent):
        scatter = sum(m * ((g / m - parent(s)) ** 2 - parent(s) * (1 - parent(s)) / m) for s, (m, g) in sites.items())
        spread = sum(m * parent(s) * (1 - parent(s)) for s, (m, g) in sites.items())
        return min(1000.0, max(1.0, spread / scatter - 1)) if scatter > 0 else 1000.0

    hosts, paths = sums(lambda i: place[i][0]), sums(lambda i: place[i])
    at_host = weight(hosts, lambda s: mean)
    at_path = weight(paths, lambda s: (hosts[s[0]][1] + at_host * mean) / (hosts[s[0]][0] + at_host))
    for i, r in found.items():
        (hn, hg), (pn, pg) = hosts[place[i][0]], paths[place[i]]
        host = (hg - own[i] + at_host * (total - own[i] + 0.5) / n) / (hn - 1 + at_host)
        path = (pg - own[i] + at_path * host) / (pn - 1 + at_path)
        assert r["host_posterior"] == pytest.approx(host) and r["path_posterior"] == pytest.approx(min(max(path, 1e-3), 1 - 1e-3))


def test_an_own_label_does_not_speak_for_itself(spark):
    docs = spark.createDataFrame([(1, "same words", "a", "p"), (2, "same words", "a", "p"), (3, "same words", "b", "p")], "doc_id long, text string, source string, lang string")
    score = {}
    for label in (0, 1):
        labels = spark.createDataFrame([(3, label, 0)], LABELS)
        rows = quality.score_quality(docs, labels, lambda: F.col("source"), lambda: F.col("lang")).collect()
        score[label] = {r["doc_id"]: r["host_posterior"] - r["path_posterior"] for r in rows}
    assert score[0][3] == pytest.approx(0, abs=1e-12) and score[1][3] == pytest.approx(0, abs=1e-12)


def test_all_sure_tokens_enter_the_model(spark):
    """However many there are: 300 tokens that only toxic documents have."""
    rows = [(i, " ".join(f"{'ct'[i % 2]}{k}" for k in range(300)) + f" n{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], LABELS)
    model = toxicity.train_toxicity(docs, labels)
    assert set(model.scores) == {f"t{k}" for k in range(300)}


# Packing


def test_added_tokens_have_their_ids():
    encoder = packing.encoder(PACKING_TOKENIZER, PACKING_RANKS)
    assert encoder.ids("a<|endoftext|>b") == [64, 50256, 65]
    draw, letters = random.Random(5), ["a", " b", "<|endoftext|>", "<|", "|>", "endoftext", "\n", " ", "é", "😀", "1", "'s"]
    for _ in range(500):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 12)))
        assert encoder.ids(text) == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# Names


CLASHING = (
    "id tree digest tampered salt place leaves part row block height nodes root lefts rights x n kept_0 kept_1 host path "
    "label bins evidence held_out predicted passages copy fingerprint first component_id its_doc its_copy its_places "
    "its_lines lines lines_removed doc places none falling guest size shard slot weight number key value score page_id "
    "url html vec_id embedding payload digest_ keep good raw node v"
).split()


def test_any_extra_column_survives(spark, awkward):
    """Every internal name is a column of the input too; results are those without."""
    plain = awkward.select(corpus_pipeline.COLUMNS)
    odd = plain.selectExpr("*", *[f"'{k}' AS `{c}`" for k, c in enumerate(CLASHING)])
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (6, 0, 1)], LABELS)
    sites = (lambda: F.col("source"), lambda: F.col("lang"))
    operators = {
        "lines": lambda d: linededup.dedup_lines(d).select("doc_id", "text", "lines", "lines_removed"),
        "simhash": lambda d: simhash.simhash_components(d, keep=("lang",)),
        "fingerprints": fingerprint.fingerprints_with_edits,
        "packing": lambda d: packing.pack_documents(d, PACKING_TOKENIZER, PACKING_RANKS).drop("sequence_id", "offset"),
        "quality": lambda d: quality.score_quality(d, labels, *sites, keep=("lang",)),
        "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.train_toxicity(d, labels), keep=("lang",)),
        "bpe": lambda d: bpe.bpe_digests(d, CODEC_RANKS),
    }
    for name, operator in operators.items():
        found, expected = operator(odd), operator(plain)
        assert found.columns == expected.columns, name
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect())), name
    kept = quality.score_quality(odd, labels, *sites, keep=("host", "bins", "kept_0", "score"))
    assert {r["host"] for r in kept.collect()} == {str(CLASHING.index("host"))} and kept.columns.count("score") == 1
    kept = toxicity.score_toxicity(odd, toxicity.train_toxicity(odd, labels), keep=("score", "kept_0"))
    assert kept.columns.count("score") == 1 and "kept_0" in kept.columns
    assert "lines_removed" in linededup.dedup_lines(odd).columns and linededup.dedup_lines(odd).count() == awkward.count()


# The pipeline


def test_pipeline_stages(spark, awkward, empty):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "line_dedup", "simhash", "packing"]
    for docs in (awkward, empty):
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, kept, "/root/testdata/sf0.001")
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= kept.count()
            kept = spark.createDataFrame(out.collect(), out.schema)


def test_scratch_goes_when_a_result_is_stored(spark, tmp_path):
    def tables(where):
        return sorted(p.name for p in where.iterdir())

    def make():
        once = frames.stored(spark.range(10), path=f"{tmp_path}/once")
        return frames.stored(once.where("id > 4"), path=f"{tmp_path}/twice")

    other = frames.stored(spark.range(3), path=f"{tmp_path}/other")
    assert frames.stored_result(spark, make, f"{tmp_path}/result").count() == 5
    assert tables(tmp_path) == ["other", "result"] and other.count() == 3

    def fail():
        make()
        raise ValueError("stop")

    with pytest.raises(ValueError, match="stop"):
        frames.stored_result(spark, fail, f"{tmp_path}/never")
    assert tables(tmp_path) == ["other", "result"]


def test_pipeline_leaves_its_result_only(spark):
    folder = Path(frames.shared_folder(spark).removeprefix("file:")) / "hearthwatt-llm"
    before = set(folder.iterdir()) if folder.exists() else set()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    assert [p.name.split("-")[:2] for p in set(folder.iterdir()) - before] == [["stage", "packing"]]


def test_near_dedup_keeps_the_smallest_id_of_each_group(spark):
    rows = [(5, "one two three four"), (2, "one two three four"), (2, "one two three four"), (9, None), (8, ""), (None, "one two three four"), (None, "else entirely it is"), (None, "else entirely it is"), (7, "quite another text here")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, "/root/testdata/sf0.001").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("2", rows[0][1]), ("7", rows[8][1]), ("8", ""), ("None", rows[6][1])]


def test_pipeline_equals_its_stages_done_plainly(spark):
    """On the small table: the decisions of the operators, applied in plain Python."""
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train_toxicity(docs, labels)
    calm = [r for r in docs.collect() if toxicity.probability(r["text"], model) < 0.5]
    calm = spark.createDataFrame(calm, docs.schema)
    rated = quality.score_quality(calm, labels, lambda: F.col("source"), lambda: F.col("lang")).collect()
    keep = {r["doc_id"] for r in rated if r["score"] >= 0.5}
    texts, seen = {}, {}
    split = {r["doc_id"]: r["text"].split("\n") for r in calm.collect() if r["doc_id"] in keep}
    for doc in sorted(split):
        lines, gone = split[doc], set()
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if any(x.strip(" ") for x in window):
                if window in seen:
                    gone |= {k, k + 1, k + 2}
                seen.setdefault(window, doc)
        texts[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    prints = {d: simhash.simhash(t, 3) for d, t in texts.items()}
    label = {p: p for p in prints.values()} | linked(brute_close(set(prints.values())))
    first = {}
    for doc in sorted(prints):
        first.setdefault(label[prints[doc]], doc)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    encoder = packing.encoder(PACKING_TOKENIZER, PACKING_RANKS)
    sizes = {}
    for r in rows:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
    assert sizes == {d: len(encoder.ids(texts[d])) + 1 for d in first.values()}
