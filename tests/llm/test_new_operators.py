"""Operators 11 to 13 against brute force, with the defined result of every awkward input."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assayline.llm import complement_packing, fill_middle, merkle, queries, tokens
from tests.comparison import connect, duckdb_result, spark_result
from tests.conftest import SMALL_TABLES

PATH = queries.TOKENIZER
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _tree string, _index int, "
    "leaf string, length int, _salt int, n string, output string, form string, members int"
)


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs anywhere, empty, blank, very long and equal texts, repeated ids and rows, clashing columns."""
    text = spark.read.parquet(f"{SMALL_TABLES}/documents.parquet").orderBy("doc_id").first().text
    rows = [(None, text, "en"), (None, None, None), (1, None, "en"), (2, "", "en"), (3, " \t\n", "de"), (4, text, "")]
    rows += [(5, text, "en")] * 3 + [(5, text, None), (6, text + " <P> more", "en"), (6, "x", "en"), (7, "a b é \x1c 語", "fr")]
    rows += [(8, "Word " * 30_000, "en"), (9, "y" * 5_000, "en"), (None, text, "en"), (10, "< <M", "en"), (11, " two  words\n ", "en")]
    rows = [(d, t, g, None if d == 7 else "s", None if d == 8 else 3) for d, t, g in rows]
    frame = spark.createDataFrame([(*r, "k", 1, "l", 5, 6, "n", "o", "f", 7) for r in rows], SCHEMA)
    return frame, rows, spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_fill_in_middle"])
def test_query_equals_its_twin(spark, name):
    types, rows = spark_result(entry.queries()[name](spark, SMALL_TABLES))
    other_types, other_rows = duckdb_result(connect(SMALL_TABLES), entry.oracle_sql()[name])
    assert types == other_types and rows == other_rows and rows


# ---- operator 11 ---------------------------------------------------------------------------------


def check_packing(rows, pieces, capacity=2048):
    expected = collections.Counter()
    for doc_id, text in rows:
        ids = tokens.text_ids(PATH, text or "") + (0).to_bytes(4, "little")
        for number, start in enumerate(range(0, len(ids) // 4, capacity)):
            part = ids[4 * start : 4 * (start + capacity)]
            expected[doc_id, number, start, len(part) // 4, zlib.crc32(part)] += 1
    assert collections.Counter(tuple(p)[:5] for p in pieces) == expected
    by_sequence = collections.defaultdict(list)
    for piece in pieces:
        by_sequence[piece.sequence_id].append((piece.offset, piece.length))
    for placed in by_sequence.values():
        ends = [0, *[a + b for a, b in sorted(placed)]]
        assert [a for a, _ in sorted(placed)] == ends[:-1] and ends[-1] <= capacity
    return len(by_sequence), -(-sum(k[3] * n for k, n in expected.items()) // capacity)


def test_best_fit_packing_is_an_exact_round_trip(spark, awkward):
    documents = spark.read.parquet(f"{SMALL_TABLES}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    used, least = check_packing(rows, complement_packing.pack(documents, PATH).collect())
    assert used <= least + 1
    check_packing([r[:2] for r in awkward[1]], complement_packing.pack(awkward[0], PATH).collect())
    assert complement_packing.pack(awkward[2], PATH).count() == 0


def test_a_hot_length_is_dealt_over_salts(spark):
    rows = [(i % 7, "one two three") for i in range(400)]
    pieces = complement_packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    used, least = check_packing(rows, pieces)
    assert used == least


def fills(counts, capacity):
    """Some two to four pieces in stock that fill a sequence exactly."""
    stock = [x for x in counts for _ in range(min(4, counts[x]))]
    return any(sum(c) == capacity for k in (2, 3, 4) for c in itertools.combinations(stock, k))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 60), max_size=9))
def test_complements_are_exhausted_and_patterns_hold_the_histogram(histogram):
    index = complement_packing.SumIndex(histogram, 30)
    exact = complement_packing.exact_complements(index)
    assert all(sum(p.lengths) == 30 and len(p.lengths) <= 4 for p in exact)
    left = {x: int(n) for x, n in enumerate(index.counts) if n}
    assert not fills(left, 30) and 30 not in left
    pairs = [sum(index.stock[a] and index.stock[s - a] for a in range(1, s)) for s in range(31)]
    assert index.pairs.tolist() == pairs
    held = collections.Counter()
    for pattern in [*exact, *complement_packing.best_fit(index)]:
        assert sum(pattern.lengths) <= 30 and pattern.count > 0
        for length in pattern.lengths:
            held[length] += pattern.count
    assert held == histogram


# ---- operator 12 ---------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def stated(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def level_up(level, fan):
    return [H(*level[i : i + fan]) for i in range(0, len(level), fan)]


def levels_of(level, fan):
    found = [level]
    while len(found[-1]) > 1:
        found.append(level_up(found[-1], fan))
    return found


def plain_audit(rows, fan=8):
    """doc_id, leaf, subroot, root, proof, folded root and verdict of (doc_id, text, lang, source, n_chars) rows."""
    trees = collections.defaultdict(list)
    for row in rows:
        crc = None if row[0] is None else zlib.crc32(str(row[0]).encode())
        text = row[1]
        if crc is not None and crc % 3 == 0 and text is not None:
            text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        trees[row[2]].append((row[0], stated(row, row[1]), stated(row, text)))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        built[name] = levels_of([leaf for _, leaf, _ in trees[name]], fan)
    top = levels_of([built[n][-1][0] for n in names], fan)
    result = []
    for number, name in enumerate(names):
        for place, (doc_id, leaf, seen) in enumerate(trees[name]):
            folded, siblings = seen, []
            for at, levels in ((place, built[name]), (number, top)):
                for level in levels[:-1]:
                    run = level[at - at % fan : at - at % fan + fan]
                    siblings += [d for i, d in enumerate(run) if i != at % fan]
                    run[at % fan] = folded
                    folded, at = H(*run), at // fan
            root = top[-1][0]
            result.append((doc_id, leaf, built[name][-1][0], root, H(*siblings), folded, folded == root))
    return result


def audited(frame, fan=8):
    lowered = F.lower("text")
    key = F.col("doc_id").cast("string").cast("binary")
    return merkle.audit(frame, F.when(F.crc32(key) % 3 == 0, lowered).otherwise(F.col("text")), fan=fan)


def test_manifest_equals_brute_force(spark, awkward):
    found = [tuple(r) for r in audited(awkward[0]).collect()]
    assert sorted(found, key=repr) == sorted(plain_audit(awkward[1]), key=repr)
    assert {r[-1] for r in found} == {True, False}
    empty = audited(awkward[2])
    assert empty.count() == 0 and empty.columns == audited(awkward[0]).columns


@pytest.mark.parametrize("bound", [merkle.BROADCAST_NODES, 30, 0])
def test_climb_by_broadcast_and_by_merge(spark, monkeypatch, bound):
    chance = random.Random(4)
    rows = [(i, f"Text {i % 900}", chance.choice(["en"] * 6 + [f"l{chance.randrange(40)}", None]), "s", i) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(merkle.climbed, "__defaults__", (bound,))
    monkeypatch.setattr(merkle, "BROADCAST_NODES", bound)
    found = sorted(tuple(r) for r in audited(frame, fan=4).collect())
    assert found == sorted(plain_audit(rows, fan=4))
    assert 0 < sum(not r[-1] for r in found) < len(rows)


def test_a_single_document_and_a_single_language(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([(1, "A", "en", "s", 1)], [(i, "A", "en", "s", 1) for i in range(20)]):
        found = sorted(tuple(r) for r in audited(spark.createDataFrame(rows, schema)).collect())
        assert found == sorted(plain_audit(rows))


def test_row_limit_of_recursions_is_put_back(spark):
    name = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(name, "12345")
    audited(spark.createDataFrame([(i, "A", "en", "s", 1) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long"))
    assert spark.conf.get(name) == "12345"
    spark.conf.unset(name)


# ---- operator 13 ---------------------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark, awkward):
    rows = [r[:2] for r in awkward[1]]
    rows += [(100 + i, t) for i, t in enumerate(["< S> <", "a<", "<S", ">M> <P", "é 語\n\n x", "　 a b ", "a" * 50] * 20)]
    schema = "doc_id long, text string"
    made = fill_middle.transform(spark.createDataFrame(rows, schema)).withColumn("back", fill_middle.restored())
    found = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()]
    assert sorted(found, key=repr) == sorted([plain_fim(*r) for r in rows], key=repr)
    assert {r[2] for r in found} == {"plain", "spm", "psm"}
    assert sorted(r.back for r in made.collect()) == sorted(t or "" for _, t in rows)
    clashing = fill_middle.transform(awkward[0])
    assert sorted(map(repr, (r.output for r in clashing.collect()))) == sorted(repr(plain_fim(*r[:2])[-1]) for r in awkward[1])
    assert fill_middle.transform(awkward[2]).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(0, 70))
def test_wavelet_ranks(classes, end):
    matrix = fill_middle.WaveletMatrix(fill_middle.np.array(classes, dtype=fill_middle.np.uint8))
    for value in range(4):
        assert matrix.rank(value, min(end, len(classes))) == classes[:end].count(value)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\nab　語", max_size=40))
def test_units_by_rank(text):
    parts = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    units = fill_middle.Units(text)
    assert units.count == len(parts)
    for k in range(len(parts) + 1):
        assert text[: units.end_of(k)] == "".join(parts[:k])
