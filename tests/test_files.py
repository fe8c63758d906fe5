from lagweave.sources import files
from lagweave.streaming import windowed_profiles


def test_fasta_gff_meme_counts(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">g1 x\nACG\nTT\n>g2\nccc\n")
    assert sorted(map(tuple, files.read_fasta(spark, str(tmp_path / "a.fa")).collect())) == [("g1", "ACGTT"), ("g2", "CCC")]
    (tmp_path / "a.gff3").write_text("##gff\nc1\ts\tgene\t5\t90\t.\t+\t.\tID=g1;Name=n\nc1\ts\texon\t5\t9\t.\t+\t.\tID=e\n")
    g = files.read_gff(spark, str(tmp_path / "a.gff3")).collect()
    assert len(g) == 1 and g[0].start == 5 and g[0].attributes["ID"] == "g1"
    (tmp_path / "m.meme").write_text("MEME version 4\n\nMOTIF M1\nletter-probability matrix: alength= 4 w= 2\n 0.5 0.5 0 0\n0 0 1 0\n\nMOTIF M2\nletter-probability matrix: alength= 4 w= 1\n1 0 0 0\n")
    m = {r.name: r.ppm for r in files.read_meme(spark, str(tmp_path / "m.meme")).collect()}
    assert m == {"M1": [[0.5, 0.5, 0, 0], [0, 0, 1, 0]], "M2": [[1, 0, 0, 0]]}
    (tmp_path / "c.txt").write_text("# tool\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tx/s1.bam\tx/s2.bam\ng1\tc\t1\t2\t+\t2\t7\t8\n")
    assert sorted(map(tuple, files.read_counts(spark, str(tmp_path / "c.txt")).collect())) == [("g1", "s1", 7), ("g1", "s2", 8)]
    assert files.read_table_or_none(spark, str(tmp_path / "none.tsv")) is None


def test_logs_lists_highlights(spark, tmp_path):
    (tmp_path / "s1.log").write_text("100 reads; of these:\n95.5% overall alignment rate\n")
    assert tuple(files.read_alignment_logs(spark, str(tmp_path / "*.log")).first()) == ("s1", 100, 95.5)
    (tmp_path / "l.txt").write_text("a # c\n\na\nb\n")
    assert sorted(r.gene for r in files.read_list(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]
    (tmp_path / "h.txt").write_text("Symbol\tGene\nS\tg1\nT\tg2\tsecondary\n")
    assert sorted(map(tuple, files.read_highlights(spark, str(tmp_path / "h.txt")).collect())) == [("S", "g1", "primary"), ("T", "g2", "secondary")]


def test_directory_and_lists_written(spark, tmp_path):
    df = spark.createDataFrame([("Lost", "a"), ("Lost", "b"), ("Gained", "a")], "edge_class string, gene string")
    files.write_lists(df, str(tmp_path / "out"), ["edge_class"])
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["edge_class=Gained", "edge_class=Lost"]
    (tmp_path / "C1.tsv").write_text("gene\tx\na\t1\n")
    (tmp_path / "C2.tsv").write_text("gene\tx\nb\t2\n")
    got = files.read_directory(spark, str(tmp_path / "C*.tsv"), r"^(C\d)")
    assert sorted((r.gene, r.source) for r in got.collect()) == [("a", "C1"), ("b", "C2")]


def test_stream(spark, tmp_path):
    src = spark.sql("SELECT timestamp '2024-01-01 01:00:00' AS ts, 'g' AS gene, 2.0D AS value UNION ALL SELECT timestamp '2024-01-01 05:00:00', 'g', 4.0D")
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = windowed_profiles(stream).writeStream.outputMode("complete").format("memory").queryName("prof").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r.n, r.value) for r in spark.table("prof").collect()] == [(2, 3.0)]
