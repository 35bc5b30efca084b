import hashlib

import corpus_pipeline
import pytest

from dwellmap import session
from dwellmap.llm import exact_dedup, line_dedup, mixing
from dwellmap.session import scratch_path

SCHEMA = "doc_id long, text string, source string, digest string, n_lines int, copies string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "c") for r in rows], SCHEMA)


def test_exact_dedup_edges(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).collect() == []
    rows = [(1, "a", "s"), (5, "a", "t"), (3, "a", None), (4, None, "s"), (9, "", "s"), (None, "b", "s")]
    rows += [(7, "x" * 500_000, "s")] * 2 + [(8, "A", "s")]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs(spark, rows)).collect()}
    assert got == {
        (1, 5, 3, False), (5, 5, 3, True), (3, 5, 3, False), (4, 9, 2, False), (9, 9, 2, True),
        (None, None, 1, False), (7, 7, 2, True), (8, 8, 1, True),
    }


def test_index_outlives_its_batches(spark):
    path = scratch_path(spark, "digests")
    index = exact_dedup.DigestIndex.create(spark, path, 4)
    index.add(docs(spark, [(1, "a", "s"), (2, "b", "s")])).collect()
    again = exact_dedup.DigestIndex.open(spark, path, 4)
    got = again.add(docs(spark, [(10, "a", "s"), (11, "c", "s"), (12, "c", "s")])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(10, 1, False), (11, 12, False), (12, 12, True)}
    stored = {(bytes(r.digest), r.keep_id) for r in again.read().collect()}
    assert stored == {(hashlib.sha256(t).digest(), k) for t, k in ((b"a", 1), (b"b", 2), (b"c", 12))}


def test_anti_join_does_not_shuffle_the_index(spark):
    index = exact_dedup.DigestIndex.create(spark, scratch_path(spark, "digests"), 8)
    index.add(docs(spark, [(1, "a", "s")])).collect()
    batch = exact_dedup.DigestIndex.open(spark, index.path, 8).read()
    plan = batch.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("Physical Plan")[1]


BOILER = "All rights reserved by nobody."


def test_line_dedup(spark):
    rows = [(i, f"own text number {i}, long enough\n {BOILER}\t\nshort", f"site{i % 12}") for i in range(24)]
    rows += [(100, BOILER, "site1"), (101, None, "site1"), (102, "", None), (None, f"kept words, kept words here, more of them\n{BOILER}\n", None)]
    rows += [(103, "x" * 400_000 + "\n" + BOILER, "site0")] * 2
    got = line_dedup.remove_spread_lines(docs(spark, rows), min_sites=10).collect()
    assert len(got) == len(rows) and got[0].digest == "d" and got[0].copies == "c"
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].text == "own text number 5, long enough\nshort"
    assert (by_id[5].n_lines, by_id[5].n_removed) == (3, 1)
    assert by_id[100].text == BOILER and by_id[100].n_removed == 0
    assert by_id[101].text is None and by_id[102].text == "" and by_id[None].text == "kept words, kept words here, more of them\n"
    assert by_id[103].text == "x" * 400_000
    assert line_dedup.remove_spread_lines(docs(spark, [])).collect() == []


def test_only_texts_copied_as_a_whole_are_left(spark):
    copied = "the first line of a copied text\nthe second line of a copied text\nits end"
    rows = [(i, copied + "  ", f"site{i}") for i in range(10)]
    rows += [(10 + i, f"own {i}\n{BOILER}", f"site{i}") for i in range(12)]
    rows += [(30, BOILER, "site1"), (31, None, "site1"), (32, "", None)]
    rows += [(40, f"two sites have\n{BOILER}", "site1"), (41, f"two sites have\n{BOILER}", "site2")]
    rows += [(50, copied + "\nand more", "site1"), (51, copied, None)]
    rows += [(None, copied, "site1"), (None, f"x\n{BOILER}", "site2")]
    got = line_dedup.remove_spread_lines(docs(spark, rows), max_share=None).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: (r.text, r.n_removed) for r in got}
    assert all(by_id[i] == (copied + "  ", 0) for i in range(10)) and by_id[51] == (copied, 0)
    assert all(by_id[10 + i] == (f"own {i}", 1) for i in range(12))
    assert by_id[30] == ("", 1) and by_id[31] == (None, 0) and by_id[32] == ("", 0)
    assert by_id[40] == by_id[41] == ("two sites have", 1)
    assert by_id[50] == ("its end\nand more", 2)
    assert {r.text for r in got if r.doc_id is None} == {copied, "x"}


def test_pipeline_takes_spread_lines_from_short_documents(spark):
    rows = [(i, f"own {i}\n{BOILER}", "en", f"site{i}", 0) for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.line_dedup_stage(spark, table, "").collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in got} == {(i, f"own {i}", len(f"own {i}")) for i in range(12)}


def test_threshold_is_exact(spark):
    rows = [(s * 100 + n, f"line seen on {n} sites", f"site{s}") for n in (8, 9, 10, 11, 12) for s in range(n)]
    rows += [(90_000 + i, "line seen on 9 sites", None) for i in range(50)]
    spread = line_dedup.spread_lines(docs(spark, rows), min_sites=10)
    want = {hashlib.md5(f"line seen on {n} sites".encode()).digest() for n in (10, 11, 12)}
    assert {bytes(r.key) for r in spread.collect()} == want


def brute_mix(rows, weights):
    copies, total = {}, {}
    for i, text, source in rows:
        total[source] = total.get(source, 0) + len((text or "").split())
    for source, target in weights.items():
        if not total[source]:
            copies |= {i: 1 for i, _, s in rows if s == source}
            continue
        passes, rest = divmod(target, total[source])
        own = sorted((hashlib.md5(f"0:{i}".encode()).hexdigest(), i, len((t or "").split())) for i, t, s in rows if s == source)
        upto = 0
        for _, i, n in own:
            upto += n
            copies[i] = passes + (upto <= rest)
    return copies


def test_mixing_meets_the_limit_and_the_brute_force(spark):
    rows = [(i, "w " * (i % 7), "big" if i % 3 else f"small{i % 4}") for i in range(600)]
    rows += [(1000, "a b", None), (1001, None, "empty"), (1002, "", "empty"), (1003, "y" * 300_000, "big")]
    table = docs(spark, rows)
    for options in ({"max_repeats": 2.0}, {"max_repeats": 1.5, "budget": None}, {"entropy": 1.2}):
        sources = mixing.source_tokens(table)
        weights = {r.source: r for r in mixing.temperature_weights(sources, **options).collect()}
        got = {r.doc_id: r.copies for r in mixing.mix(table, **options).collect()}
        assert got == brute_mix(rows, {s: r.target_tokens for s, r in weights.items()})
        if "max_repeats" in options:
            repeats = [r.target_tokens / r.tokens for r in weights.values() if r.tokens]
            assert max(repeats) <= options["max_repeats"] + 1e-6
        if options.get("budget", 1) is None:
            assert min(got.values()) >= 1
    assert mixing.mix(docs(spark, []), max_repeats=2.0).collect() == []


def test_mixing_draws_repeated_rows_alike(spark):
    rows = [(1, "a b c", "s")] * 3 + [(2, "a", "t"), (None, "a b", "s"), (None, "a b", "s")]
    got = mixing.mix(docs(spark, rows), max_repeats=2.0).collect()
    assert len(got) == 6 and len({(r.doc_id, r.copies) for r in got}) == 3


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["room", "passes", "whole", "b_block", "rest", "s", "cut", "order", "tokens", "doc", "n_tokens"]
    rows = [(i, "w " * (i % 5), f"s{i % 3}", *[f"{c}{i}" for c in names]) for i in range(60)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names)
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, schema), max_repeats=1.5).collect()}
    assert len(got) == 60
    for i, r in got.items():
        assert [r[c] for c in names[:-1]] == [f"{c}{i}" for c in names[:-1]]
        assert r["n_tokens"] == i % 5


def test_the_cut_is_found_digit_by_digit(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DIGITS", 1)
    rows = [(i, "w " * (i % 4), "a" if i % 3 else "b") for i in range(700)] + [(5, "w w w", "a")] * 40
    table = docs(spark, rows)
    sources = mixing.source_tokens(table)
    weights = {r.source: r for r in mixing.temperature_weights(sources, max_repeats=1.3).collect()}
    got = {r.doc_id: r.copies for r in mixing.mix(table, max_repeats=1.3).collect()}
    assert got == brute_mix(rows, {s: r.target_tokens for s, r in weights.items()})


def test_the_index_knows_its_buckets_and_finds_owners_later(spark):
    index = exact_dedup.DigestIndex.create(spark, scratch_path(spark, "digests"), 8)
    first = docs(spark, [(None, "only without id", "s"), (1, "a", "s"), *[(i, f"t{i}", "s") for i in range(2, 60)]])
    assert {r.kept for r in index.add(first).where("doc_id IS NULL").collect()} == {False}
    with pytest.raises(ValueError, match="8 buckets"):
        exact_dedup.DigestIndex.open(spark, index.path, 4)
    again = exact_dedup.DigestIndex.open(spark, index.path)
    rows = [(5000, "only without id", "s"), (5001, "a", "s"), *[(900 + i, f"t{i}", "s") for i in range(2, 60)]]
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(docs(spark, rows)).collect()}
    assert got[5000] == (5000, True) and got[5001] == (1, False)
    assert not any(got[900 + i][1] for i in range(2, 60))


@pytest.mark.parametrize("max_share", [None, 0.5])
def test_lines_are_keyed_once(spark, max_share, monkeypatch):
    """Estimates, exact counts and each document's lines come from one table of keys, which is gone in the end."""
    kept, gone = [], []
    monkeypatch.setattr(line_dedup, "materialise", lambda df: kept.append(df.columns) or session.materialise(df))
    monkeypatch.setattr(line_dedup, "discard", lambda *tables: gone.extend(t.columns for t in tables))
    spread = "a line that stands everywhere"
    rows = [(i, f"{spread}\n {spread} \nonly text number {i}, but long enough", f"s{i}") for i in range(12)]
    got = line_dedup.remove_spread_lines(docs(spark, rows), max_share=max_share).collect()
    assert [c for c in kept if "keys" in c] == gone and len(gone) == 1
    assert {(r.n_lines, r.n_removed) for r in got} == {(3, 2 if max_share is None else 0)}
