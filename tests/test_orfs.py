"""Open reading frames against a plain scan of whole contigs, for every size of chunk."""

import random

import pytest

from contiglink.operators import orfs
from contiglink.sources import fasta


def plain(seq, least):
    """(start, end, strand, partial) of every frame of a contig, codon by codon."""
    out, n = [], len(seq)
    flip = str.maketrans("ACGTacgt", "TGCAtgca")
    for strand in (1, -1):
        text = seq if strand == 1 else seq[::-1].translate(flip)
        for f in range(3):
            whole = [i for i in range(f, n - 2, 3)]
            start, edge = (f, True) if whole else (None, False)
            for i in whole:
                codon = text[i : i + 3].upper()
                if codon in orfs.STOPS:
                    if start is not None:
                        out.append((start, i + 3, strand, edge, False))
                    start, edge = None, False
                elif start is None and codon in orfs.STARTS:
                    start = i
            if start is not None:
                out.append((start, whole[-1] + 3, strand, edge, True))
    got = []
    for a, b, strand, no_start, no_stop in out:
        if b - a >= least:
            got.append((a + 1, b, 1, f"{int(no_start)}{int(no_stop)}") if strand == 1 else (n - b + 1, n - a, -1, f"{int(no_stop)}{int(no_start)}"))
    return sorted(got)


@pytest.mark.parametrize("chunk", [3, 7, 100, orfs.CHUNK])
def test_scan(spark, tmp_path, chunk):
    r = random.Random(5)
    seqs = {f"c_{k}": "".join(r.choice("ACGTacgtN" if k % 4 == 0 else "ACGT") for _ in range(r.randrange(0, 700))) for k in range(14)}
    seqs |= {"open": "ATGGCC" * 150, "tiny": "AT", "stop": "TAA", "low": "G" * 500}
    with open(tmp_path / "x.fasta", "w") as out:
        for k, s in seqs.items():
            out.write(f">{k} x\n" + "".join(s[i : i + 50] + "\n" for i in range(0, len(s), 50)))
    index = fasta.index_fasta_file(spark, str(tmp_path / "x.fasta"))
    for least, span in ((12, 1 << 20), (60, 40)):
        got = {}
        for x in orfs.orf_scan(fasta.fasta_ranges(orfs.chunks_of(index, chunk), index), index, least, chunk, span).collect():
            contig, _, n = x.orf.rpartition("_")
            got.setdefault(contig, []).append((int(n), x.start, x.end, x.strand, x.metadata))
        for k, s in seqs.items():
            want = plain(s, least)
            mine = sorted(got.get(k, []))
            assert sorted((a, b, strand, m.split("partial=")[1]) for _, a, b, strand, m in mine) == want, (k, chunk)
            assert [m[0] for m in mine] == list(range(1, len(want) + 1)) and [m[1] for m in mine] == sorted(m[1] for m in mine)
        assert sum(map(len, got.values())) > 10
