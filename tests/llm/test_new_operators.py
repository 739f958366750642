"""Source divergence, line dedup and spelling variants beside their SQL and plain versions."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tools.check_oracle import compare
from wardline.llm import divergence, line_runs, spelling
from wardline.llm.queries import ORACLES, QUERIES

NEW = ["op11_source_divergence", "op12_line_dedup", "op13_spelling_variants"]


@pytest.fixture(scope="module")
def shared(spark, awkward, tmp_path_factory):
    """The awkward rows, three times over, and rows that share lines and words with variants, as a table."""
    line = "  This line is found in very many of the documents of the table\t"
    rows = []
    for i in range(60):
        word = "variant" if i % 5 else ("varian", "varjant", "vvariant", "Variant", "variänt")[i // 5 % 5]
        text = f"{line}\nown line number {i} with words that nothing else has {i * 7919}\n{word} naïve÷word {word}\n"
        if i % 3 == 0:
            text += line.upper() + "\n" + "short\n" * (i % 4) + "Ä zweite Zeile, die in vielen Texten der Tabelle steht"
        rows.append((i + 20 if i % 10 else None, text, ("en", "de", None)[i % 3], f"s{i % 7}" if i % 4 else None, 1))
    rows += rows[7:9] + [(500, line + "\n" + line + "\r\n \n", "en", "s1", 1), (500, line, "en", "s1", 1)]
    more = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = tmp_path_factory.mktemp("shared")
    docs = awkward.union(awkward).union(awkward).unionByName(more, allowMissingColumns=True)
    docs.withColumn("at", F.lit("x")).withColumn("n", F.lit("x")).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def documents(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", NEW)
def test_agrees_with_sql_on_awkward_rows(spark, shared, name):
    assert not compare(QUERIES[name](spark, shared), documents(shared), ORACLES[name])


@pytest.mark.parametrize("name", NEW)
def test_empty_table(spark, nothing, tmp_path, name):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


# 11: source divergence


def test_terms_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Äpfel und Birnen, don't 12ab34 x​y\x7fz " * 20
    plain = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    assert [t.decode() for p in divergence.term_pieces(text.encode()) for t in p] == plain


@pytest.mark.parametrize("cells", [1 << 20, 5])
def test_rows_equal_dense_sums(monkeypatch, cells):
    """Also in slices of a few cells, with groups without terms, and with shares near the largest."""
    monkeypatch.setattr(divergence, "CELLS", cells)
    rng = np.random.default_rng(3)
    table = rng.integers(0, 5, (9, 40)) * (rng.random((9, 40)) < 0.4) * np.array([[1], [1], [10**9], [1], [3], [0], [1], [1], [1]])
    sizes = table.sum(axis=1) + 40
    starts = np.concatenate([[0], np.cumsum((table > 0).sum(axis=0))])
    peers = np.concatenate([np.flatnonzero(table[:, t]) for t in range(40)])
    counts = np.concatenate([table[table[:, t] > 0, t] for t in range(40)])
    got = list(divergence.accumulate(starts, peers, counts, sizes))
    share = [[1 + 10**9 * (int(c) + 1) // int(s) for c in row] for row, s in zip(table, sizes)]
    want = [[sum((p - q) ** 2 // q for p, q in zip(a, b)) for b in share] for a in share]
    assert [r.tolist() for r in got] == want


def test_shares_of_very_large_counts():
    counts, size = np.array([0, 7, 5 * 10**12]), np.array([6 * 10**12] * 3)
    assert divergence.shares(counts, size).tolist() == [1 + 10**9 * (c + 1) // (6 * 10**12) for c in counts.tolist()]


def test_blocks_add_up(spark, shared, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 50)
    assert not compare(QUERIES[NEW[0]](spark, shared), documents(shared), ORACLES[NEW[0]])


# 12: line dedup


@pytest.mark.parametrize("batches, fan", [(1, 2), (7, 2), (5, 3)])
def test_batches_and_levels_do_not_change_the_result(spark, shared, batches, fan):
    docs = spark.read.parquet(f"{shared}/documents.parquet")
    got = line_runs.dedup_lines(docs, batches=batches, fan=fan)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped", "kept_text"]
    got = got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
    assert not compare(got, documents(shared), ORACLES[NEW[1]])


def test_runs_stay_disjoint_and_are_compacted(spark):
    runs = line_runs.LineRuns(spark, fan=2, buckets=3)
    for batch in range(5):
        lines = spark.range(batch * 10, batch * 10 + 30).selectExpr(
            "id AS _row_id", "id AS _row", "id % 45 AS h1", "0L AS h2"
        )
        runs.add(lines)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r.h1 for name in runs.runs() for r in spark.table(name).collect()]
    assert sorted(held) == list(range(45))
    counts = Counter(i % 45 for b in range(5) for i in range(b * 10, b * 10 + 30))
    want = {(k, max(i for i in range(70) if i % 45 == k)) for k, n in counts.items() if n >= 4}
    assert {(r.h1, r.owner) for r in runs.common(4).collect()} == want
    plan = runs.fresh(spark.range(9).selectExpr("id AS h1", "id AS h2"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    runs.close()


def test_line_dedup_has_no_python(spark, shared):
    plan = QUERIES[NEW[1]](spark, shared)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 13: spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


@pytest.mark.parametrize("crowded", [1024, 3])
def test_near_pairs_are_all_pairs_one_edit_apart(spark, crowded):
    """Also where nearly every bucket is crowded, and for words of two letters only."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abéz") for _ in range(rng.randint(5, 7))) for _ in range(250)}
    words |= {"".join(rng.choice("ab") for _ in range(6)) for _ in range(60)} | {"a" * k for k in range(5, 12)} | {"x" * 3000, "x" * 2999}
    words = sorted(words)
    frame = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n bigint")
    got = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(frame, crowded).collect()]
    want = [(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)]
    assert sorted(got) == sorted(want)


def test_roots_follow_the_chain(spark):
    forms = spark.createDataFrame([(f"w{k:02}", f"w{k + 1:02}") for k in range(21)] + [("x", "w05")], "word string, form string")
    got = {r.word: r.root for r in spelling.roots(forms).collect()}
    assert got == {**{f"w{k:02}": "w21" for k in range(21)}, "x": "w21"}


def test_words_are_counted_over_pieces(spark, monkeypatch):
    text = "Großes großes GROSSES wort wörter wörter-wörter × ÷÷÷÷÷ " * 40
    whole = Counter()
    for run in re.findall("[A-Za-zÀ-ÿ]+", text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        word = spelling.damaged(low, spelling.zlib.crc32(b"5:"))
        whole[word] += len(word) >= 5
    monkeypatch.setattr(spelling, "PIECE", 11)
    got = Counter()
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([text])], names=["doc_id", "text"])
    for part in spelling._counted([batch]):
        got.update(dict(zip(part.column("word").to_pylist(), part.column("n").to_pylist())))
    assert got == +whole
