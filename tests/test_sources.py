import gzip

import pytest

from duplexa.sources import annotation, fasta, predictions, profiles

GTF = """#!genome x
chr1\tt\ttranscript\t201\t800\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; RPKM "1500";
chr1\tt\texon\t201\t800\t.\t+\t0\tgene_id "g1"; transcript_id "t1"; RPKM "1500";
chr1\tt\texon\t900\t950\t.\t-\t0\tgene_id "g2"; transcript_id "t2";
"""
GENCODE = """##gff-version 3
chr1\tt\texon\t1\t9\t.\t+\t.\tID=exon:e1;gene_id=G1;transcript_id=T1;RPKM=5
chr1\tt\texon\t20\t29\t.\t+\t.\tID=exon:e2;gene_id=G%2C2;transcript_id=T2%252C;RPKM=bad
"""
ENSEMBL = "1\te\texon\t1\t9\t.\t+\t.\tParent=transcript:ENST1;RPKM=2.5\n1\te\texon\t5\t9\t.\t+\t.\tID=exon:E2;RPKM=1\n"


def write(folder, name, text):
    path = folder / name
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def collected(frame):
    return [tuple(r) for r in frame.orderBy("start").collect()]


def test_gtf(spark, tmp_path):
    rows = collected(annotation.read_annotation(spark, write(tmp_path, "a.gtf", GTF)))
    assert rows == [("chr1", 201, 800, "+", "g1", "t1", 1500.0), ("chr1", 900, 950, "-", "g2", "t2", 0.0)]
    assert annotation.read_annotation(spark, str(tmp_path / "a.gtf"), feature="").count() == 3


def test_gff3_dialects_whatever_the_name(spark, tmp_path):
    rows = collected(annotation.read_annotation(spark, write(tmp_path, "a.gtf", GENCODE)))
    assert rows == [("chr1", 1, 9, "+", "G1", "T1", 5.0), ("chr1", 20, 29, "+", "G,2", "T2%2C", 0.0)]
    rows = collected(annotation.read_annotation(spark, write(tmp_path, "b.txt.gz", ENSEMBL)))
    assert [r[4:6] for r in rows] == [("ENST1", "ENST1"), ("E2", "E2")]


def test_an_annotation_without_any_score_is_refused(spark, tmp_path):
    path = write(tmp_path, "a.gtf", GTF)
    with pytest.raises(ValueError, match="TPM"):
        annotation.read_annotation(spark, path, score="TPM")


def test_bed(spark, tmp_path):
    six = write(tmp_path, "a.bed", "chr1\t10\t20\tt1\tx\t+\nchr1\t30\t40\tt2\t7\t-\n")
    assert collected(annotation.read_annotation(spark, six)) == [("chr1", 10, 20, "+", "t1", "t1", 0.0), ("chr1", 30, 40, "-", "t2", "t2", 7.0)]
    seven = write(tmp_path, "b.bed", "chr1\t10\t20\tt1\t3\t+\t9.5\n")
    assert collected(annotation.read_annotation(spark, seven))[0][-1] == 9.5
    assert collected(annotation.read_annotation(spark, seven, kind="bed6"))[0][-1] == 3.0


def test_predictions(spark, tmp_path):
    text = "s1\t1\t21\tchr1\t10\t30\t+\t-12.5\tmore\tyet\n\t1\t21\tchr1\t10\t30\t+\t-1\ns1\t1\t21\tchr1\t50\t70\t-\t-20.25\n"
    rows = predictions.read_predictions(spark, write(tmp_path, "p.out", text))
    assert collected(rows) == [("s1", "chr1", 10, 30, "+", -12.5), ("s1", "chr1", 50, 70, "-", -20.25)]
    write(tmp_path, "q.tsv.gz", "s2\t1\t21\tchr2\t5\t25\t+\t-11\n")
    folder = predictions.read_prediction_folder(spark, str(tmp_path))
    assert sorted((r["sirna_id"], r["raw_e_min"]) for r in folder.collect()) == [("s1", -20.25), ("s1", -20.25), ("s2", -11.0)]
    assert predictions.best_site_in_text(spark, str(tmp_path / "p.out")) == (-20.25, 50, 70, "-")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        predictions.read_prediction_folder(spark, str(tmp_path / "none"))


def test_fasta(spark, tmp_path):
    path = write(tmp_path, "g.fa", ">chr1 first > one\nACGT\n\nAC\n>chr2\nTT\r\nGG")
    assert sorted(tuple(r) for r in fasta.read_fasta(spark, path).collect()) == [("chr1", "ACGTAC"), ("chr2", "TTGG")]
    with pytest.raises(ValueError, match="s1"):
        fasta.read_sirnas(spark, write(tmp_path, "s.fa", ">s1\nAC\n>s1 again\nGG\n"))


def test_on_target_lists_take_the_last_row(spark, tmp_path):
    path = write(tmp_path, "t.tsv", "# id\ttarget\n\ns1\tt1\ns2\ns1\tt9\ns3\tt3\n")
    assert sorted(tuple(r) for r in profiles.read_on_targets(spark, path).collect()) == [("s1", "t9"), ("s3", "t3")]


def test_profiles_round_trip(spark, tmp_path):
    made = spark.createDataFrame([("chr1", "+", 1, [0.5, 1.5]), ("chr1", "-", 1, [2.0, 3.0])], "chrom string, strand string, position int, u array<float>")
    profiles.write_profiles(made, str(tmp_path / "out"))
    assert sorted(map(tuple, profiles.read_profiles(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, made.collect()))
    flat = spark.createDataFrame([(1, "+", 0.5, 1.5)], "position int, strand string, u1 float, u2 float")
    flat.coalesce(1).toPandas().to_parquet(tmp_path / "chr7.parquet")
    assert profiles.read_profiles(spark, str(tmp_path / "chr7.parquet")).first()["chrom"] == "chr7"


def test_the_format_is_told_however_late(spark, tmp_path):
    short = "chr1\tx\n" * 300
    row = "chr1\tx\texon\t1\t9\t.\t+\t.\t"
    cases = {
        "a": (short + row + "ID=exon:e;Parent=transcript:t;gene_id=g;RPKM=2\n", "gff3"),
        "b": ("#!x\n" + short + row + 'gene_id "g"; transcript_id "t"; RPKM "2";\n', "gtf"),
        "c": ("##gff-version 3\n" + row + "x y\n", "gff3"),
        "d": ("# ID=x\n\n", "gtf"),
        "e": ("", "gtf"),
        "f": ("#\t\t\t\t\t\t\t\tID=x\n" + row + 'note "a=b"\n', "gtf"),
    }
    for name, (text, kind) in cases.items():
        (tmp_path / name).write_text(text)
        assert annotation.file_format(spark.read.text(str(tmp_path / name))) == kind


def test_bed_headers_are_no_features(spark, tmp_path):
    (tmp_path / "a.bed").write_text('# made by hand\nbrowser position chr1\ntrack name="x"\n\nchr1\t1\t9\tt1\t2.5\t+\nchr2\t3\t9\tt2\tno\t-\n')
    got = annotation.read_annotation(spark, str(tmp_path / "a.bed"))
    assert [(r["chrom"], r["start"], r["exp_value"]) for r in got.orderBy("chrom").collect()] == [("chr1", 1, 2.5), ("chr2", 3, 0.0)]
