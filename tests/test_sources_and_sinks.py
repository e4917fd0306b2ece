import pytest
from pyspark.errors import AnalysisException

from wordloom import sources as S
from wordloom.sinks import write_tsv


def values(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_lines_of_files_and_of_tables_agree(spark, corpus, tmp_path):
    texts = ["a\r\nb\rc\n", "\n", "x", "y\n\nz"]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.txt").write_bytes(text.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    table = corpus(*[(str(n), text) for n, text in enumerate(texts)], ("empty", ""))
    assert values(S.read_lines(spark, str(tmp_path))) == values(S.text_lines(table))


def test_documents_from_files(spark, tmp_path):
    for folder, name, text in [
        ("x", "a.b.txt", "one\ntwo"), ("x", "plain", "three"), ("x", "two words.txt", "four"),
        ("y", "a.b.md", "five"), ("y", "1+1 ä 50%.txt", "six"),
    ]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    documents = S.documents_from_files(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert values(documents) == [
        ("1+1 ä 50%", "six"),
        ("a.b", "five"), ("a.b", "one"), ("a.b", "two"), ("plain", "three"), ("two words", "four"),
    ]


def test_keyed_documents(lines):
    rows = S.keyed_documents(lines("d1\tsome text", "no tab", "d2\ta\tb", "d3\t", "\tx"))
    assert values(rows) == [("", "x"), ("d1", "some text"), ("d2", "a\tb"), ("d3", "")]


def test_document_table_deals_out_rows_when_told_and_drops_empty_texts(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    rows = [(n, "x" * (n % 3), "other") for n in range(30)]
    spark.createDataFrame(rows, "id int, body string, more string").coalesce(1).write.parquet(path)
    table = S.document_table(spark, path, "id", "body")
    assert table.columns == ["doc_id", "text"]
    assert table.count() == 20
    assert table.rdd.getNumPartitions() == 1
    assert S.document_table(spark, path, "id", "body", partitions=3).rdd.getNumPartitions() == 3


def test_document_table_reads_a_file_of_many_splits_where_it_lies(spark, tmp_path, sample):
    path = str(tmp_path / "many")
    spark.read.parquet(f"{sample}/documents.parquet").repartition(8).write.parquet(path)
    plan = S.document_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Not(EqualTo(text,))" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_word_list(lines):
    frame = lines(" The ", "the", "A.*", "")
    assert values(S.word_list(frame)) == [("",), ("a.*",), ("the",)]
    assert S.small_word_list(frame) == ["", "a.*", "the"]
    with pytest.raises(ValueError):
        S.small_word_list(frame, max_words=2)


def test_vocabulary(lines):
    frame = lines("Apple\t3", " pear \t2\t1", "plum", "\t\t", "Apple\t9")
    assert values(S.vocabulary(frame)) == [(" pear ",), ("Apple",), ("plum",)]
    assert values(S.vocabulary(frame, normalise=True)) == [("apple",), ("pear",), ("plum",)]


def test_term_counts(lines):
    frame = lines("a\t3", "b\t2\t1", "c", "d\t4\t", "e\t")
    assert values(S.term_counts(frame)) == [("a", 3), ("d", 4)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.term_counts(lines("a\tx")).collect()
    assert values(S.term_counts(lines("a\tx", "b\t-1", "c\t7"), digits_only=True)) == [("c", 7)]


def test_write_tsv(spark, tmp_path):
    rows = spark.createDataFrame([(f"w{n:03d}", n) for n in reversed(range(200))], "w string, n long")
    path = str(tmp_path / "out")
    write_tsv(rows, path, order_by=["w"])
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    text = "".join(p.read_text() for p in parts)
    assert text == "".join(f"w{n:03d}\t{n}\n" for n in range(200))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_tsv(rows, path)
    write_tsv(rows.limit(3), path, overwrite=True)
    assert spark.read.text(path).count() == 3


def test_ranked_words_survive_a_file(spark, corpus, tmp_path):
    from wordloom.operators import top_words, word_count

    counts = top_words(word_count(corpus(("d", "b a b c\nc b"))), 2)
    path = str(tmp_path / "top")
    write_tsv(counts, path)
    lines = S.read_lines(spark, path)
    assert values(S.vocabulary(lines)) == [("b",), ("c",)]
    assert values(S.term_counts(lines)) == [("b", 3), ("c", 2)]


def test_fields_keep_their_places_and_maps_are_stripes(spark):
    from wordloom.sinks import tsv_lines

    rows = spark.createDataFrame([(None, "a", 1, {"y": 2, "x": 1})], "p string, q string, n long, m map<string,long>")
    assert values(tsv_lines(rows)) == [("\ta\t1\t{x=1, y=2}",)]
    with pytest.raises(TypeError):
        tsv_lines(rows.selectExpr("array(1) as a"))


def test_order_within_files(spark, tmp_path):
    from wordloom.sinks import write_tsv

    rows = spark.range(200).selectExpr("lpad(cast(id * 37 % 200 as string), 3, '0') as k", "id")
    write_tsv(rows, str(tmp_path / "out"), order_by=["k"], within_files=True)
    parts = [p.read_text().split() for p in (tmp_path / "out").glob("part-*")]
    keys = [part[::2] for part in parts]
    assert all(k == sorted(k) for k in keys) and sorted(sum(keys, [])) == sorted(r.k for r in rows.collect())


def test_a_large_file_is_numbered_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from wordloom.sinks import read_numbered_lines

    (tmp_path / "out").mkdir()
    texts = {0: "".join(f"{n}\r\n\n" for n in range(300)), 1: "", 2: "x\n" + "y" * 700 + "\nz"}
    for number, text in texts.items():
        (tmp_path / "out" / f"part-0000{number}-a.txt").write_text(text, newline="")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        lines = read_numbered_lines(spark, str(tmp_path / "out"))
        found = lines.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    wanted = [(0, i, f"{i // 2}\r" if i % 2 == 0 else "") for i in range(600)]
    wanted += [(2, 0, "x"), (2, 1, "y" * 700), (2, 2, "z")]
    assert sorted(tuple(r)[:3] for r in found) == wanted
    assert len({r["task"] for r in found if r["file_number"] == 0}) > 1


def test_documents_of_one_split_are_written_by_several_tasks(spark, tmp_path):
    from wordloom.sinks import write_documents

    path = str(tmp_path / "out")
    documents = spark.range(0, 40, 1, 1).selectExpr("id as doc_id", "concat('text ', id) as text")
    write_documents(documents, path)
    names = [p.name for p in (tmp_path / "out").glob("part-*")]
    assert len(names) == 40
    assert len({name.split("-")[1] for name in names}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(f"text {n}" for n in range(40))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_documents(documents, path)
    write_documents(documents.limit(3), path, overwrite=True)
    assert spark.read.text(path).count() == 3


def test_documents_on_a_local_disk_start_no_process_and_keep_their_checksums(spark, tmp_path):
    """With the former writer, Hadoop took two processes to set the modes of a file."""
    from pyspark.sql import functions as F

    from wordloom.sinks import write_documents

    path = tmp_path / "a b%20"
    texts = ["x" * 512, "", None, "ä\nb\r\n", "y" * 2000, "\n"]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    write_documents(rows, str(path))
    parts = sorted(path.glob("part-*"))
    assert sorted(p.read_bytes() for p in parts) == sorted(((t or "") + "\n").encode() for t in texts)
    assert sorted(p.name for p in path.iterdir() if p not in parts) == sorted(
        ["_SUCCESS", "._SUCCESS.crc", *(f".{p.name}.crc" for p in parts)]
    )
    assert {p.stat().st_mode & 0o777 for p in path.iterdir()} == {0o644}
    read = spark.read.text(str(path), wholetext=True)
    assert sorted(r.value for r in read.collect()) == sorted((t or "") + "\n" for t in texts)
    largest = max(parts, key=lambda p: p.stat().st_size)
    largest.write_bytes(b"z" + largest.read_bytes()[1:])
    with pytest.raises(Exception, match="(?i)checksum"):
        read.collect()

    begun = int(open("/proc/stat").read().split("processes ")[1].split()[0])
    many = spark.range(0, 3000, 1, 1).select("id", F.lit("text").alias("text"))
    write_documents(many, str(path), overwrite=True)
    begun = int(open("/proc/stat").read().split("processes ")[1].split()[0]) - begun
    assert len(list(path.glob("part-*"))) == 3000
    assert begun < 3000  # processes and threads of the whole machine; 6000 before


def test_no_documents_leave_a_folder_that_can_be_read(spark, tmp_path):
    from wordloom.sinks import write_documents

    rows = spark.range(5).selectExpr("id as doc_id", "'x' as text")
    write_documents(rows, str(tmp_path / "out"))
    write_documents(rows.filter("doc_id > 9"), str(tmp_path / "out"), overwrite=True)
    assert S.documents_from_files(spark, str(tmp_path / "out")).collect() == []
    assert [p.stat().st_size for p in (tmp_path / "out").glob("part-*")] == [0]


def test_whole_files_have_the_lines_of_a_line_reader(spark, tmp_path, monkeypatch):
    import gzip

    from pyspark.sql import functions as F

    from wordloom.sources import corpora

    mark = b"\xef\xbb\xbf"
    texts = [
        b"", b"\n", b"a", b"a\n", b"a\n\n", b"\r\r\n\n\r", b"a\r\nb\rc\nd", b"\ra\r", mark, mark + b"\n",
        mark + b"a\n" + mark, b"\xff\xfe\n\xe4b\r\nc\n", mark + b"\xff\r", "ä\u0085b\u2028c\x0bd\n".encode(),
    ]
    for n, text in enumerate(texts):
        (tmp_path / f"{n:02d}.txt").write_bytes(text)
    (tmp_path / "14.gz").write_bytes(gzip.compress(b"packed\nlines"))
    (tmp_path / "15.txt").write_bytes(b"large\n" * 50)
    (tmp_path / "16").write_bytes(b"no ending")
    name = F.substring(F.col("_metadata.file_name"), 1, 2).alias("name")
    wanted = values(spark.read.text(str(tmp_path)).select(name, F.col("value").cast("binary")))
    for whole in (1 << 20, 100, -1):
        monkeypatch.setattr(corpora, "WHOLE", whole)
        found = S.documents_from_files(spark, str(tmp_path)).select("doc_id", F.col("text").cast("binary"))
        assert values(found) == wanted


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    """Each file counts as 4 MB where Spark deals them out; 400 made 13 tasks before."""
    for n in range(400):
        (tmp_path / f"{n}.txt").write_text(f"line\n{n}\n")
    documents = S.documents_from_files(spark, str(tmp_path))
    assert documents.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert documents.count() == 800
