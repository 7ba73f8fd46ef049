import gzip
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from termfit import (
    inverse_document_frequency,
    read_corpus,
    read_corpus_parts,
    read_folds,
    read_labelled,
    read_lines,
    read_pairs,
    read_ratings,
    read_table,
    score_corpus,
    score_parts,
    write_corpus,
    write_ranked,
    write_scalar,
    write_scores,
)
from tests.test_text import DOCS


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lines(spark, tmp_path):
    put(tmp_path / "a.txt", "one two\nthree\n")
    put(tmp_path / "b.txt", "four")
    assert sorted(r["text"] for r in read_lines(spark, str(tmp_path)).collect()) == ["four", "one two", "three"]
    assert read_lines(spark, str(tmp_path / "a*")).count() == 2


def test_corpus_keeps_empty_files(spark, tmp_path):
    for name, text in DOCS:
        put(tmp_path / name, text)
    corpus = read_corpus(spark, str(tmp_path))
    assert corpus.columns == ["doc_id", "text"]
    found = {row["doc_id"].rsplit("/", 1)[1]: row["text"] for row in corpus.collect()}
    assert found == dict(DOCS)
    idf = {r["term"]: round(r["idf"], 6) for r in inverse_document_frequency(corpus).collect()}
    assert idf["the"] == 0.693147 and idf["dog"] == 1.386294
    assert read_corpus(spark, str(tmp_path / "d[12]")).count() == 2


def named(table):
    return table.selectExpr("element_at(split(doc_id, '/'), -1) AS doc_id", "* EXCEPT (doc_id)")


@pytest.mark.parametrize("separator", [None, " "])
def test_parts_of_a_corpus_score_like_whole_files(spark, tmp_path, separator):
    for name, text in [*DOCS, ("a long one", "the cat\nand the\rdog\r\n" * 400 + "end")]:
        put(tmp_path / name, text)
    parts = read_corpus_parts(spark, str(tmp_path), separator)
    assert parts.columns == ["doc_id", "text"] and parts.count() > 800
    assert parts.select("doc_id").distinct().count() == len(DOCS) + 1  # with the empty file
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in named(score_parts(parts)).collect()}
    whole = {(r["doc_id"], r["term"]): r["tfidf"] for r in named(score_corpus(read_corpus(spark, str(tmp_path)))).collect()}
    assert found == pytest.approx(whole) and len(found) > 8
    with pytest.raises(ValueError):
        read_corpus_parts(spark, str(tmp_path), ",")


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = put(tmp_path / "big", "one two three\n" * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        parts = read_corpus_parts(spark, path)
        assert parts.where("text <> ''").rdd.getNumPartitions() > 8 and parts.count() == 20_000
        scored = score_parts(parts.unionByName(parts.limit(1).selectExpr("'other' AS doc_id", "'four' AS text")))
        assert {r["term"]: round(r["tfidf"], 3) for r in scored.collect()}["one"] == round(20_000 * 0.6931471805599453, 3)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pairs_of_every_shape(spark, tmp_path):
    path = put(
        tmp_path / "pairs",
        "(u'w', 3)\n('w2', 3)\n(user,3.000000)\n('v', 1.5e-05)\n('n', np.float64(1.5))\n"
        '("it\'s", -2)\n\n(u\'caf\\xe9\', 7L)\n(u\'\\u0142a\', 1)\n(\'a\\\\x\\\'"b\', 2)\n(a, b, 4)\n',
    )
    found = [(r["term"], r["value"]) for r in read_pairs(spark, path).collect()]
    assert found == [
        ("w", 3.0),
        ("w2", 3.0),
        ("user", 3.0),
        ("v", 1.5e-05),
        ("n", 1.5),
        ("it's", -2.0),
        ("caf\u00e9", 7.0),
        ("\u0142a", 1.0),
        ("a\\x'\"b", 2.0),
        ("a, b", 4.0),
    ]


def test_bad_pairs_fail_or_drop(spark, tmp_path):
    path = put(tmp_path / "pairs", "('a', 1)\ngarbage\n('b', x)\n")
    with pytest.raises(PySparkException, match="not a \\(term, value\\) line"):
        read_pairs(spark, path).collect()
    assert [r["term"] for r in read_pairs(spark, path, "drop").collect()] == ["a"]
    with pytest.raises(ValueError):
        read_pairs(spark, path, "ignore")
    dropped = Observation()
    assert read_pairs(spark, path, "drop", dropped).select("term").count() == 1
    assert dropped.get["dropped"] == 2


def fails_however_it_is_read(df):
    for read in (df, *(df.select(column) for column in df.columns)):
        with pytest.raises(PySparkException, match="not a"):
            read.collect()
        with pytest.raises(PySparkException, match="not a"):
            read.count()


@pytest.mark.parametrize("line", ["garbage", "('b', x)", "('a')"])
def test_bad_pairs_fail_in_every_projection(spark, tmp_path, line):
    fails_however_it_is_read(read_pairs(spark, put(tmp_path / "pairs", f"('a', 1)\n{line}\n")))


@pytest.mark.parametrize("line", [",5,1.0", "4,,2.0", "6,7,", "1,2,abc", "1,x,3", "1,2", "1,2,3,4", f"{2**70},1,1"])
def test_bad_ratings_fail_in_every_projection(spark, tmp_path, line):
    fails_however_it_is_read(read_ratings(spark, put(tmp_path / "ratings", f"1,10,5\n{line}\n")))


@pytest.mark.parametrize("line", ["({'a': 1}, 2)", "({'a': }, 1)", "garbage"])
def test_bad_points_fail_in_every_projection(spark, tmp_path, line):
    fails_however_it_is_read(read_labelled(spark, put(tmp_path / "points", f"({{'a': 1}}, 1)\n{line}\n")))


def test_numbers_that_are_not_finite(spark, tmp_path):
    scores = spark.createDataFrame([("a", float("nan")), ("b", float("inf")), ("c", float("-inf"))], "term string, value double")
    write_scores(scores, str(tmp_path / "text"), "text")
    found = {r["term"]: str(r["value"]) for r in read_pairs(spark, str(tmp_path / "text")).collect()}
    assert found == {"a": "nan", "b": "inf", "c": "-inf"}
    path = put(tmp_path / "python", "('a', nan)\n('b', inf)\n('c', -inf)\n")
    assert {r["term"]: str(r["value"]) for r in read_pairs(spark, path).collect()} == found


@pytest.mark.parametrize(
    ("line", "x"),
    [
        ("({u'caf\\xe9': 1}, 1)", {"caf\u00e9": 1.0}), ("({1: 2.0}, 1)", {"1": 2.0}), ("({'a': 1L}, 1L)", {"a": 1.0}),
        ("({'a': np.float64(1.5)}, 1)", {"a": 1.5}), ("({'a': 1,}, 1)", {"a": 1.0}), ("({'it\\'s': 1, u'\\u0142': 2}, 1)", {"it's": 1.0, "\u0142": 2.0}),
    ],
)
def test_labelled_shapes(spark, tmp_path, line, x):
    assert read_labelled(spark, put(tmp_path / "points", line + "\n")).first()["x"] == x


def test_text_tables_hold_two_columns(spark, tmp_path):
    wide = spark.createDataFrame([(1, "a", 0.5)], "doc_id int, term string, tfidf double")
    for write in (lambda: write_scores(wide, str(tmp_path / "x"), "text"), lambda: write_ranked(wide, str(tmp_path / "y"))):
        with pytest.raises(ValueError, match="two columns"):
            write()


def test_ratings_and_folds(spark, tmp_path):
    put(tmp_path / "fold0", "1,10,5\n1, 20,3.5\n")
    put(tmp_path / "fold1", "2,10,4e0\n")
    rows = read_folds(spark, str(tmp_path), 2).orderBy("user_id", "item_id").collect()
    assert [tuple(r) for r in rows] == [(1, 10, 5.0, 0), (1, 20, 3.5, 0), (2, 10, 4.0, 1)]
    bad = put(tmp_path / "bad", "1,x,3\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_ratings(spark, bad).collect()


def test_labelled(spark, tmp_path):
    path = put(
        tmp_path / "points",
        "({'a': 1, 'b': 2.5}, 1)\n({\"a\": -1e-3}, -1)\n({u'f1': 3, u\"f2\": 0.5}, +1)\n({}, -1)\n"
        "({\"it's\": 2, 'q': 1}, 1.0)\n",
    )
    df = read_labelled(spark, path)
    assert df.select("row_id").distinct().count() == 5
    assert [(r["y"], r["x"]) for r in df.orderBy("row_id").collect()] == [
        (1, {"a": 1.0, "b": 2.5}),
        (-1, {"a": -0.001}),
        (1, {"f1": 3.0, "f2": 0.5}),
        (-1, {}),
        (1, {"it's": 2.0, "q": 1.0}),
    ]
    bad = put(tmp_path / "bad", "({'a': 1}, 1)\n({'a': 1}, 2)\n({'a': }, 1)\n")
    with pytest.raises(PySparkException, match="not a"):
        read_labelled(spark, bad).collect()
    dropped = Observation()
    assert read_labelled(spark, bad, "drop", dropped).count() == 1
    assert dropped.get["dropped"] == 2


def test_scores_roundtrip(spark, tmp_path):
    scores = spark.createDataFrame([("a", 1.5e-7), ("o'b\\c", 2.0)], "term string, value double")
    write_scores(scores, str(tmp_path / "text"), "text")
    write_scores(scores, str(tmp_path / "parquet"))
    wanted = sorted(map(tuple, scores.collect()))
    assert sorted(map(tuple, read_pairs(spark, str(tmp_path / "text")).collect())) == wanted
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "parquet")).collect())) == wanted
    with pytest.raises(ValueError):
        write_scores(scores, str(tmp_path / "x"), "csv")


def test_ranked_and_scalar_files(spark, tmp_path):
    top = spark.createDataFrame([("b", 3), ("a", 3), ("z", 9)], "term string, tf bigint")
    write_ranked(top, str(tmp_path / "top"))
    lines = [r["text"] for r in read_lines(spark, str(tmp_path / "top")).collect()]
    assert lines == ["(z, 9.000000)", "(a, 3.000000)", "(b, 3.000000)"]
    write_scalar(spark.range(1).select((F.lit(1.0) / 3).alias("cosine")), str(tmp_path / "scalar"))
    assert read_lines(spark, str(tmp_path / "scalar")).first()["text"] == "0.333333"


def test_tables_are_pruned_and_small_ones_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 AS twice", "id * 3 AS thrice").coalesce(1).write.parquet(path)
    df = read_table(spark, path, ["id", "twice"])
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint,twice:bigint>" in plan
    assert df.count() == 100


def test_a_ranked_list_is_short(spark, tmp_path, monkeypatch):
    from termfit.sources import writers

    monkeypatch.setattr(writers, "MOST_RANKED", 3)
    scores = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "term string, value double")
    write_ranked(scores, str(tmp_path / "top"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "top")).collect()] == ["(b, 3.000000)", "(c, 2.000000)", "(a, 1.000000)"]
    with pytest.raises(ValueError, match="at most 3 rows"):
        write_ranked(scores.union(scores), str(tmp_path / "more"))
    assert not (tmp_path / "more").exists()


def test_corpora_of_small_files_open_each_file_once(spark, tmp_path):
    """One file per document: no process or driver step per file on writing, and larger tasks than 32 files on reading."""
    texts = [None, "", "a b\nc", "é x"] + [f"the word {i}" for i in range(796)]
    folder = str(tmp_path / "corpus")
    write_corpus(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), folder)
    names = os.listdir(folder)
    assert len(names) == len(texts) and all(name.startswith("part-") for name in names)  # no checksum files beside them
    (tmp_path / "corpus" / "nothing + 1%").write_bytes(b"")
    corpus = read_corpus(spark, folder)
    assert sorted(r["text"] for r in corpus.collect()) == sorted([*((t or "") + "\n" for t in texts), ""])
    assert {r["doc_id"] for r in corpus.collect()} == {f"file:{folder}/{name}" for name in [*names, "nothing + 1%"]}
    slots = spark.sparkContext.defaultParallelism
    parts = read_corpus_parts(spark, folder)
    assert sorted(r["text"] for r in parts.collect()) == sorted(["", "", "", "a b", "c", *texts[3:]])
    for table in (corpus, parts):
        assert table.where("text <> ''").rdd.getNumPartitions() <= 5 * slots < 800 / 32 + slots * 5
    assert read_corpus(spark, f"{folder}/part-000000-*,{folder}/no*").where("text = ''").count() == 1
    with pytest.raises(FileExistsError):
        write_corpus(corpus, folder)


def test_compressed_files_are_unpacked(spark, tmp_path):
    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"one two"))
    put(tmp_path / "b", "three")
    assert sorted(r["text"] for r in read_corpus(spark, str(tmp_path)).collect()) == ["one two", "three"]


def test_parts_without_terms_count_as_documents(spark):
    parts = spark.createDataFrame([("a", "x"), ("a", "1"), ("b", "2"), ("b", None), ("c", ""), (None, "x")], "doc_id string, text string")
    scored = {(r["doc_id"], r["term"]): round(r["tfidf"], 6) for r in score_parts(parts).collect()}
    assert scored == {("a", "x"): 0.693147, (None, "x"): 0.693147}


@pytest.mark.parametrize("read", [read_corpus, read_corpus_parts])
def test_tasks_list_folders_as_the_file_index_does(spark, tmp_path, monkeypatch, read):
    """The driver holds no list of files, and the same files are found with the same names and texts."""
    from termfit.sources import folders, readers

    folder = tmp_path / "x=1" / "files"
    folder.mkdir(parents=True)
    for i in range(300):
        put(folder / f"f{i:03d}", f"one\ntwo {i}\n")
    for name in ("_hidden", ".hidden", "copied._COPYING_", "é b+%41", "b[1]", "b1", "{c}"):
        put(folder / name, f"{name} is here" * 9)
    (folder / "_folder").mkdir()
    put(folder / "_folder" / "inner", "inside")
    (folder / "empty").write_bytes(b"")
    (folder / "broken").write_bytes(b"one \xff\xfe two\r\nthree")
    os.symlink(folder / "nowhere", folder / "link")
    os.symlink(folder / "b1", folder / "other")
    monkeypatch.setattr(readers, "SMALL_FILE", 80)
    monkeypatch.setattr(folders, "PACK_FILES", 7)
    places = [f"file://{folder}", f"{folder}/{{b1,f[0-1]?[!1-3],_folder}}", f"{tmp_path}/*/f*/b\\[1\\]"]
    places += [f"{folder}/f00*,{folder}/e*"] if read is read_corpus else []
    found = [read(spark, place) for place in places]
    assert max(len(table._jdf.inputFiles()) for table in found) < 100
    monkeypatch.setattr(readers, "list_files", lambda *_: None)
    for table, place in zip(found, places, strict=True):
        wanted = sorted(map(tuple, read(spark, place).collect()))
        assert wanted and sorted(map(tuple, table.collect())) == wanted, place


def test_folders_in_folders_are_left_to_the_file_index(spark, tmp_path):
    from termfit.sources.folders import list_files

    (tmp_path / "lang=en").mkdir()
    put(tmp_path / "lang=en" / "a", "one")
    (tmp_path / "c").mkdir()
    put(tmp_path / "c" / "_metadata", "two")
    for name in ("", "n*", "c"):
        assert list_files(spark, [str(tmp_path / name)], 10) is None
    assert list_files(spark, [str(tmp_path / "lang=*")], 10).count() == 1
    for read in (read_corpus, read_corpus_parts):
        with pytest.raises(PySparkException):
            read(spark, str(tmp_path / "nothing")).collect()


def test_counts_are_added_up_where_parts_are_read(spark, tmp_path, monkeypatch):
    """Only documents whose parts lie in several tasks, or have very many terms, are exchanged term by term."""
    from termfit.operators import pieces
    from termfit.operators.text import document_term_frequency

    texts = [f"the cat {i} {'abc'[i % 3]}\nthe\n\n{'xyz'[i % 3]} cat" for i in range(40)]
    write_corpus(spark.createDataFrame([(t,) for t in [*texts, "", None]], "text string"), str(tmp_path / "corpus"))
    parts = read_corpus_parts(spark, str(tmp_path / "corpus")).cache()
    counted = document_term_frequency(parts, packed=True)
    assert counted.count() == parts.count() > 160
    added = pieces.add_up_in_place(counted)
    assert added.count() == 42 and added.where("counts IS NULL OR size(counts) = 0").count() == 2
    wanted = parts.selectExpr("doc_id", "text").groupBy("doc_id").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    tf = document_term_frequency(wanted)
    assert sorted(added.select("doc_id", F.inline("counts")).collect()) == sorted(tf.collect())
    scored = {(r["doc_id"], r["term"]): r["tfidf"] for r in score_corpus(wanted).collect()}
    for table, most, rows in ((parts, 500_000, 7), (parts.repartition(4), 500_000, 2000), (parts, 3, 2000)):
        monkeypatch.setattr(pieces, "HELD_TERMS", most)
        monkeypatch.setattr(pieces, "ROWS", rows)
        found = score_parts(table)
        assert {(r["doc_id"], r["term"]): r["tfidf"] for r in found.collect()} == pytest.approx(scored)
