"""The registered queries on the small tables: against SQL, or against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from compare import connect, duckdb_result, spark_result
from hearthwatt.llm.bpe import ranks
from hearthwatt.llm.queries import CODEC_RANKS, ORACLES, QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return dict(table(spark, SF_DIR, "documents").select("doc_id", "text").collect())


def rows_of(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    columns, rows = spark_result(QUERIES[name](spark, SF_DIR))
    expected_columns, expected_rows = duckdb_result(connect(SF_DIR), ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_op1(spark, texts):
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    rows = rows_of(spark, "op1_closed_syncmers")
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    found = {}
    for r in rows:
        text, following = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert found.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert np.mean([r["near_edited"] for r in rows]) > 0.4 > 0.1 > np.median([r["near_next"] for r in rows])


def test_op2(spark, texts):
    rows = rows_of(spark, "op2_best_two_fit")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    held, pieces = {}, {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    total = 0
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, start)
            assert r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())
            assert k == 0 or r["length"] == 2048
            start += r["length"]
        assert start == len(ids)
        total += len(ids)
    assert len(held) <= total / 2048 * 1.02 + 1


def test_op3(spark):
    rows = {r["doc_id"]: r for r in rows_of(spark, "op3_toxic_segments")}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_op3_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op3_toxic_segments"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = scored.select("predicted", "toxic").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    assert np.mean([r["predicted"] for r in rows if r["toxic"]]) > 0.85
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.01


def test_op4(spark, texts):
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(CODEC_RANKS), special_tokens={}
    )
    for r in rows_of(spark, "op4_byte_bpe"):
        text = texts[r["doc_id"]]
        ids = encoding.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op5(spark, texts):
    prints = {d: plain_simhash(t) for d, t in texts.items()}
    group = {d: d for d in prints}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    rows = rows_of(spark, "op5_simhash")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        d: (f"{p:016x}", top(d)) for d, p in prints.items()
    }


def test_op6_recall(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in table(spark, SF_DIR, "embeddings").collect()}
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], np.float64)
    found = {}
    for r in rows_of(spark, "op6_nn_descent"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [i for i in ids if i % 20 == 0]
    right = 0
    for query, rows in found.items():
        scores = matrix @ np.array(vectors[query], np.float64)
        others = sorted(s for s, i in zip(scores, ids, strict=True) if i != query)
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and query not in {r[1] for r in rows}
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        assert all(abs(r[2] - scores[np.searchsorted(ids, r[1])]) < 1e-12 for r in rows)
        right += sum(r[2] >= others[-20] - 1e-12 for r in rows)
    assert right / (20 * len(found)) > 0.95


def test_op7_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op7_site_quality"](spark, sf_dir).where("held_out").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = scored.select("keep", "quality").collect()
    assert np.mean([r["keep"] == r["quality"] for r in rows]) > 0.95


def test_op10_keeps_the_article(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF_DIR, "pages").collect()}
    for r in rows_of(spark, "op10_main_text"):
        inner = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0]
        words = re.sub(r"<[^>]*>?", " ", inner).replace("&amp;", "&").replace("&quot;", '"').split()
        assert r["text"].split() == words and r["n_chars"] == len(r["text"])
