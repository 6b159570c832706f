"""FASTA files by byte ranges: indexes and sequences for every size of piece; checks of inputs; single files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from contiglink.sources import fasta, inputs, single, tables


def invented(r, folder):
    """Files with lines of any width, Windows line ends, a record on one line, no newline at the end, text before the first header."""
    seqs, where = {}, 0
    for f, end in enumerate(("\n", "\r\n", "\n")):
        data = "; a remark\nnot of any record\n" if f == 2 else ""
        for k in range(12):
            n, width = r.randrange(0, 400), r.choice([7, 60, 10**6])
            seq = "".join(r.choice("ACGT") for _ in range(n))
            seqs[f"f{f}_{k}"] = seq
            data += f">f{f}_{k} {'long ' * r.randrange(20)}{end}" + "".join(seq[i : i + width] + end for i in range(0, n, width))
        with open(f"{folder}/x{f}.fasta", "w", newline="") as out:
            out.write(data.rstrip() if f == 0 else data)
    return seqs


@pytest.mark.parametrize("piece", [11, 64, 1000, fasta.PIECE])
def test_ranges_equal_the_sequences(spark, tmp_path, piece):
    r = random.Random(7)
    seqs = invented(r, tmp_path)
    index = fasta.index_fasta_file(spark, f"{tmp_path}/*.fasta", piece)
    assert {x.contig: x.length for x in index.collect()} == {k: len(s) for k, s in seqs.items()}
    beds = []
    for k, s in seqs.items():
        for j in range(5):
            a = r.randrange(-3, len(s) + 3)
            beds.append((k, a, a + r.randrange(-2, 90), f"t{j}", "x"))
        beds.append((k, 0, len(s), "all", "x"))
    bed = spark.createDataFrame(beds + [("other", 0, 5, "t", "x")], "contig string, start long, stop long, region_title string, part string")
    for part in (13, fasta.PART):
        got = {}
        for x in sorted(fasta.fasta_ranges(bed, index, part).collect()):
            assert len(x.sequence) <= part
            got[x.name] = got.get(x.name, "") + x.sequence
        assert got == {f"{t}::{k}:{a}-{b}": seqs[k][a:b] for k, a, b, t, _ in beds if 0 <= a < b <= len(seqs[k])}


def test_parts_are_written_in_order(spark, tmp_path):
    rows = [(f"r{k}", p, "ACGT"[p % 4] * 3) for k in range(30) for p in range(5)]
    random.Random(1).shuffle(rows)
    fasta.write_parts(spark.createDataFrame(rows, "name string, part int, sequence string").repartition(6), f"{tmp_path}/out")
    got = {x.name: x.sequence for x in tables.read_fasta(spark, f"{tmp_path}/out").collect()}
    assert got == {f"r{k}": "AAACCCGGGTTTAAA" for k in range(30)}


def test_a_record_larger_than_what_is_read_at_once(spark, tmp_path):
    unit = "".join(random.Random(3).choice("ACGT") for _ in range(1000))
    with open(tmp_path / "big.fasta", "w") as out:
        out.write(">big\n")
        for _ in range(30_000):
            out.write(unit)  # 30 MB on one line
        out.write("\n>next\nACGT\n")
    index = fasta.index_fasta_file(spark, str(tmp_path / "big.fasta"), 1 << 20)
    assert {x.contig: (x.length, x.linebases) for x in index.collect()} == {"big": (30_000_000, 30_000_000), "next": (4, 4)}
    bed = spark.createDataFrame([("big", 29_999_995, 30_000_000, "end"), ("big", 12_345_678, 12_345_690, "mid"), ("next", 0, 4, "n"), ("big", 1_000_000, 9_000_000, "long")], "contig string, start long, stop long, region_title string")
    got = fasta.fasta_ranges(bed, index).groupBy("name").agg(F.count("*").alias("n"), F.sum(F.length("sequence")).alias("size"), F.min("sequence").alias("s")).collect()
    assert {x.name.split(":")[0]: (x.n, x.size) for x in got} == {"end": (1, 5), "mid": (1, 12), "n": (1, 4), "long": (8, 8_000_000)}
    assert next(x.s for x in got if x.name.startswith("mid")) == unit[678:690] and next(x.s for x in got if x.name.startswith("end")) == unit[-5:]


def test_inputs(spark, tmp_path):
    for name, text in (("a.tsv", "x\n"), ("b1.tsv", "y\n"), ("b2.tsv", ""), ("empty.tsv", "")):
        (tmp_path / name).write_text(text)
    os.makedirs(tmp_path / "folder")
    (tmp_path / "folder" / "part-0").write_text("z")
    (tmp_path / "folder" / "_SUCCESS").write_text("")
    os.makedirs(tmp_path / "none")
    found = inputs.resolve(spark, {"one": f"{tmp_path}/a.tsv", "many": f"{tmp_path}/b*.tsv", "folder": f"file://{tmp_path}/folder", "both": [f"{tmp_path}/a.tsv", f"{tmp_path}/b1.tsv"], "off": None})
    assert {k: [x.rsplit("/", 1)[1] for x in v] for k, v in found.items()} == {"one": ["a.tsv"], "many": ["b1.tsv", "b2.tsv"], "folder": ["part-0"], "both": ["a.tsv", "b1.tsv"]}
    with pytest.raises(inputs.InputError) as e:
        inputs.resolve(spark, {"gone": f"{tmp_path}/no.tsv", "glob": f"{tmp_path}/q*.tsv", "empty": f"{tmp_path}/empty.tsv", "dir": f"{tmp_path}/none", "store": "nosuch://x/y", "fine": f"{tmp_path}/a.tsv"}, {"db": "the database"})
    told = str(e.value).splitlines()
    assert len(told) == 6 and "the database (db)" in told[0] and not any(x.startswith("fine") for x in told)
    assert [inputs.sample_of(x) for x in ("/d/s1.fasta", "s3://b/x.fasta.fasta", "plain", "a/b.fasta/")] == ["s1", "x.fasta", "plain", "b"]


def test_single_file(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.concat(F.lit("ä"), F.col("id").cast("string")).alias("name")).repartition(9)
    single.write_single(df, f"{tmp_path}/o/one.tsv", order=["n"])
    want = "n\tname\n" + "".join(f"{x.n}\t{x.name}\n" for x in sorted(df.collect()))
    assert (tmp_path / "o" / "one.tsv").read_text() == want and os.listdir(tmp_path / "o") == ["one.tsv"]
    single.write_single(df.limit(0), f"file://{tmp_path}/o/none.tsv", order=["n"])
    assert (tmp_path / "o" / "none.tsv").read_text() == "n\tname\n"
    single.write_single(df.limit(3), f"{tmp_path}/o/bare.tsv", header=False)
    assert len((tmp_path / "o" / "bare.tsv").read_text().splitlines()) == 3
    with pytest.raises(ValueError):
        single.write_single(df, "s3a://bucket/one.tsv")
