"""The registered queries of the package over whole sample tables, against DuckDB or plain computations."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pytest
from compare import TESTDATA, differences, views

from starloom.llm import catalog, decontaminate, mixing, sharding

SF = "sf0.001"
LARGER = "sf0.01"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{TESTDATA / SF / 'documents.parquet'}'").fetchall())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def rows(spark, name, sf=SF):
    return catalog.QUERIES[name](spark, str(TESTDATA / sf)).collect()


@pytest.mark.parametrize("name", catalog.ORACLES)
def test_query_equals_statement(spark, name):
    assert differences(spark, views(SF), name, catalog.QUERIES[name], catalog.ORACLES[name], SF) is None


@pytest.mark.parametrize("name", ["op2_licences", "op4_pseudonyms", "op9_mixing", "op10_sharding"])
def test_native_queries_run_no_python(spark, name):
    plan = catalog.QUERIES[name](spark, str(TESTDATA / SF))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_language_is_known_where_it_was_not_learned(spark, texts):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{TESTDATA / LARGER / 'documents.parquet'}'").fetchall())
    found = rows(spark, "op1_language_id", LARGER)
    assert len(found) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def tiled(item, text, least):
    """Greedy string tiling by its definition."""
    marked, used, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best, length = [], least
        for a in range(len(item)):
            for b in range(len(text)):
                k = 0
                while (
                    a + k < len(item) and b + k < len(text)
                    and item[a + k] == text[b + k] and not marked[a + k] and not used[b + k]
                ):
                    k += 1
                if k > length:
                    best, length = [(a, b)], k
                elif k == length:
                    best.append((a, b))
        if not best:
            return covered
        for a, b in best:
            if not any(marked[a : a + length]) and not any(used[b : b + length]):
                marked[a : a + length] = used[b : b + length] = [True] * length
                covered += length


def test_leaks_equal_tiling_by_its_definition(spark, texts):
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{TESTDATA / SF / 'benchmark.parquet'}'").fetchall())
    expected = set()
    for doc, text in texts.items():
        own = words(text)
        seeds = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for item, passage in items.items():
            wanted = words(passage)
            if len(wanted) < 5 or not seeds & {tuple(wanted[i : i + 5]) for i in range(len(wanted) - 4)}:
                continue
            n = tiled(wanted, own, decontaminate.TILE)
            if n * 100 >= decontaminate.COVERED * len(wanted):
                expected.add((doc, item, n, len(wanted)))
    assert {tuple(r) for r in rows(spark, "op3_decontamination")} == expected
    assert expected


def test_toxic_documents_are_told_from_clean_ones(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{TESTDATA / 'sf0.1' / 'labels.parquet'}'").fetchall())
    found = rows(spark, "op6_toxicity", "sf0.1")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    counts = Counter((labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels)
    assert counts[1, 1] >= 0.85 * (counts[1, 0] + counts[1, 1])
    assert counts[0, 1] <= 0.03 * (counts[0, 0] + counts[0, 1])


def test_bad_documents_are_told_from_good_ones(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{TESTDATA / LARGER / 'labels.parquet'}'").fetchall())
    found = rows(spark, "op7_line_quality", LARGER)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def jaccard_components(texts):
    sets = {}
    for doc, text in texts.items():
        w = words(text)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    holders, parent = defaultdict(list), {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for doc, own in sets.items():
        shared = Counter(other for s in own for other in holders[s])
        for other, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[other]) - n):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(doc)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_components_equal_all_pairs(spark):
    path = TESTDATA / LARGER / "documents.parquet"
    larger = dict(duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall())
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op8_jaccard_join", LARGER)}
    assert found == jaccard_components(larger)


def jump(key, shards):
    state = int(hashlib.md5(str(key).encode()).hexdigest()[:12], 16)
    at, target = 0, 0
    while target < shards:
        at = target
        state = (state * sharding.MULTIPLIER + sharding.INCREMENT) % (1 << 48)
        target = int((at + 1) * (2147483648.0 / ((state >> 17) + 1)))
    return at


def test_shards_equal_the_plain_generator(spark, texts):
    found = rows(spark, "op10_sharding")
    assert len(found) == len(texts)
    for r in found:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], 24), jump(r["doc_id"], 25))
        assert r["grown_shard"] in (r["shard"], 24)
    for shard in range(24):
        ordered = sorted((r["doc_id"], r["slot"]) for r in found if r["shard"] == shard)
        assert [slot for _, slot in ordered] == list(range(len(ordered)))


def test_pipeline_keeps_what_its_rules_keep(spark, texts):
    sf_dir = str(TESTDATA / SF)
    docs = catalog.table(spark, sf_dir, "documents")
    toxic = {r["doc_id"] for r in rows(spark, "op6_toxicity") if r["predicted"]}
    clean = {d: t for d, t in texts.items() if d not in toxic}
    first = {d: t for d, t in clean.items() if jaccard_components(clean)[d][1] == d}
    leaked = {r["doc_id"] for r in rows(spark, "op3_decontamination")}
    kept = {d: t for d, t in first.items() if d not in leaked}
    frame = docs.where(docs.doc_id.isin(list(kept)))
    mixed = mixing.chosen(frame, corpus_pipeline.MIXED, seed="mix-1", domains=catalog.DOMAINS, weights=catalog.WEIGHTS)
    expected = {r["doc_id"]: jump(r["doc_id"], 24) for r in mixed.select("doc_id").collect()}
    assert {r["doc_id"]: r["shard"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == expected
    assert 0 < len(expected) < len(kept) < len(first) < len(clean)
