"""Single-value functions on the recorded cases."""

import pytest
from pyspark.sql import functions as F

from taxaloom.functions import bases as B
from taxaloom.functions import fixed_values as V
from taxaloom.functions import rules as R
from taxaloom.functions import taxa as X
from taxaloom.functions import text as S


def test_bucket_first_match_blank_and_default(values):
    rules = [("A", "ab"), ("B", "b")]
    assert values(lambda c: R.bucket(c, rules), ["xAB", "b", "", "  ", None, "z"]) == ["A", "B", "Not recorded", "Not recorded", "Not recorded", "Other / unclear"]


def test_all_matches_and_exactly_one(values):
    rules = [("x", "foo"), ("y", "bar")]
    assert values(lambda c: R.all_matches(c, rules, "none"), ["foo BAR", "bar", "", None]) == ["x;y", "y", "none", "none"]
    assert values(lambda c: R.exactly_one(c, rules), ["foo bar", "bar", "q"]) == [None, "y", None]


def test_clean_taxon(values):
    assert values(X.clean_taxon, ["k__Bacteria(99)", "D_0__Archaea", " __x ", "g__"]) == ["Bacteria", "Archaea", "x", ""]


def test_feature_domain(values):
    cells = ["non-viral microbial feature", "bacteria/archaea (UHGG)", "k__Bacteria", "Unassigned", "Myoviridae phage", "Fungi"]
    assert values(X.feature_domain, cells) == [None, None, "Bacteria", None, "Viruses", "Fungi"]


def test_unit_bucket(values):
    assert values(X.unit_bucket, ["read count (not rarefied, not normalised)", "rarefied counts", "counts, not normalised or rarefied",
                                  "relative abundance", "normalization status not stated; read counts", ""]) == [
        "Read count (raw / filtered)", "Read count (rarefied / equal depth)", "Read count (raw / filtered)",
        "Relative abundance (proportion / percent)", "Read count (raw / filtered)", "Not recorded"]


def test_disease_bucket(values):
    assert values(X.disease_bucket, ["not labelled ASD (0CTRL)", "not labelled", "n/a", "healthy", "CRC patient", "", "weird"]) == [
        "Control / healthy", "Not reported", "Not applicable (environmental / no disease design)", "Control / healthy", "Case / disease",
        "Not recorded", "Other label"]


def test_normalise_disease(values):
    assert values(X.normalise_disease, ["CRC", "MS", "lupus", ""]) == [
        {"name": "Colorectal cancer", "how": "merged synonym"}, {"name": "MS", "how": "verbatim (abbreviation undefined in source)"},
        {"name": "Lupus", "how": "verbatim"}, {"name": "", "how": ""}]


def test_suffix_rank(values):
    assert values(X.ictv_rank, ["Myoviridae", "Caudoviricetes", "Moumouvirus", "Duplodnaviria"]) == ["family", "class", None, "kingdom"]


def test_host_of(values):
    got = values(X.host_of, [("", "soil", ""), ("", "", ""), ("Homo sapiens", "soil", ""), ("", "mouse gut", ""), ("", "stool", "Pig")], "a string, b string, c string")
    assert got == ["Environmental / none", "Not recorded", "Human", "Mouse", "Pig"]


def test_paper_domain_and_clauses(values):
    assert values(X.paper_domain, ["bacteria, archaea, fungi and viruses", "16S OTU; ITS fungal OTUs kept separately", "ITS1 amplicon", "bacteria and archaea genus", "vOTU table", "xyz"]) == [
        "Unclassified", "Bacteria", "Fungi", "Bacteria", "Viruses", "Unclassified"]
    assert values(X.drop_clauses, ["a; b kept out", "kept separately"]) == ["a", "kept separately"]


def test_table_domain(values):
    got = values(X.table_domain, ["d__Bacteria;p__Chloroflexi", "Bacteroides_fragilis", "Patescibacteria", "crAss phage"])
    assert [g["domain"] for g in got] == ["prokaryote", "prokaryote", "unknown", "virus"]
    assert got[3]["evidence"] == "matched virus pattern 'phage'"


def test_split_taxonomy(values):
    got = values(X.split_taxonomy, ["OTU_412", "Bacteria;Firmicutes;Clostridia", "d__Bacteria;p__Chloroflexi;c__", "k__A|k__B"])
    assert [list(g.values()) for g in got] == [
        [""] * 7, ["Bacteria", "Firmicutes", "Clostridia", "", "", "", ""], ["Bacteria", "Chloroflexi", "", "", "", "", ""], ["B"] + [""] * 6]


def test_sample_flags(values):
    got = values(X.sample_flags, [("NTC1", "a"), ("mock", "16S.csv"), ("blank_2", ""), ("S1", "x_wgs.tsv")], "a string, b string")
    assert [(g["control"], g["assay"]) for g in got] == [("blank_or_control", ""), ("blank_or_control", "16S"), ("blank_or_control", ""), ("", "WGS")]


def test_branch_of(values):
    rows = [("WGS", "VIRAL RNA", None), ("WGS", "GENOMIC", None), ("WGS", "METAGENOMIC", None), ("AMPLICON", "METAGENOMIC", "PCR"), ("WGS", "METAGENOMIC", "size fractionation"), (None, None, None)]
    got = values(X.branch_of, rows, "a string, b string, c string")
    assert [g["branch"] for g in got] == ["rna", "unsupported_isolate_genome", "dna_shotgun", "amplicon", "dna_virome", "unresolved"]
    assert values(X.branch_of_marker, ["primer_like_16S_V4", "ITS1", "x", ""]) == ["amplicon_16s", "amplicon_its", "amplicon_other", "unresolved"]


def test_scope_match(values):
    scope = "human|homo sapiens ; gut|stool"
    assert values(X.scope_match, [(scope, "mouse gut"), (scope, "Homo sapiens stool"), ("", "x")], "a string, b string") == [False, True, True]


def test_lenient_numbers(values):
    assert values(S.lenient_int, ["12.0", "", "x", None, " 7 ", "5d", "nan", "-3.9", "1e2"]) == [12, 0, 0, 0, 7, 0, 0, -3, 100]
    assert values(S.lenient_double, ["1_000", ".5", "5.", "inf", "+2"]) == [None, 0.5, 5.0, None, 2.0]


def test_identifiers(values):
    assert values(S.normalize_id, [" HTTPS://doi.org/10.1/AbC ", "PMC1"]) == ["10.1/abc", "pmc1"]
    assert values(S.paper_key, [("", " ", "PMC9"), ("10.1/X", "1", "")], "a string, b string, c string") == ["pmc9", "10.1/x"]
    assert values(S.safe_name, ["d__Bacteria;p__Préfix x"]) == ["d__Bacteria_p__Préfix_x"]
    assert values(S.ascii_surname, ["Ramírez AL, Páez L", "van der Berg J", "O'Neil"]) == ["Ramirez", "vanderBerg", "ONeil"]


def test_ranges_and_accessions(values):
    assert values(S.expand_ranges, ["SRR10-12", "x err5-ERR6; PRJNA1", "none"]) == [["SRR10", "SRR11", "SRR12"], ["ERR5", "ERR6"], []]
    assert values(S.expand_ranges, ["SRR12-10; SRR1-2"]) == [["SRR1", "SRR2"]]
    got = values(S.parse_accessions, ["PRJNA494608 (isolate genomes, previous study)", "SRR1-3; srr2, CRA7\nPRJEB9", None])
    assert got[0] == {"supported": [], "unsupported": []}
    assert got[1] == {"supported": ["SRR1", "SRR2", "SRR3", "PRJEB9"], "unsupported": ["CRA7"]}
    assert got[2] == {"supported": [], "unsupported": []}


def test_small_text_functions(values):
    assert values(S.mate_of, ["a_1.fastq", "a_2.fq.gz", "a.fq"]) == ["R1", "R2", "single"]
    assert values(S.union_values, [("b;a", "c; a"), ("", None)], "a string, b string") == ["a;b;c", ""]
    assert values(S.clean_missing, [" Missing ", None, "x"]) == ["not_reported", "not_reported", "x"]
    assert values(S.letter_suffix, [1, 26, 27, 52, 702, 703], "a int") == ["a", "z", "aa", "az", "zz", "aaa"]
    assert values(S.truthy, ["True", "1", "no", None]) == [True, True, False, False]
    assert values(S.flag_challenge_page, [bytearray(b"<html>"), bytearray(b"a,b\n"), bytearray(b" " * 600 + b"<html")], "a binary") == [True, False, False]


def test_letter_suffix_of_any_width(values):
    def expected(n):
        out = ""
        while n > 0:
            n, letter = divmod(n - 1, 26)
            out = chr(97 + letter) + out
        return out

    sums = [sum(26**k for k in range(1, w + 1)) for w in range(1, 14)]
    numbers = [0, 18_278, 18_279, 2**53 + 1, 2**63 - 1, *[s + d for s in sums for d in (-1, 0, 1)]]
    assert values(S.letter_suffix, numbers, "a long") == [expected(n) for n in numbers]
    assert values(S.letter_suffix, [None], "a long") == [None]


def test_first_nonblank_on_map(spark):
    entries = [F.lit(v) for v in ("Host ", "", "HOST", "pig", "Organism", "rat")]
    df = spark.range(1).select(F.create_map(*entries).alias("m"))
    row = df.select(S.first_nonblank(S.lower_keys(F.col("m")), ["host", "organism"]).alias("v"))
    assert row.first().v == "pig"


def test_bases(values):
    assert values(B.revcomp, ["ACGTN", "GTGYCAGC", "AXT"]) == ["NACGT", "GCTGRCAC", "ANT"]
    primer = V.PRIMERS["16S_V4"][0]
    exact = "GTGCCAGCAGCCGCGGTAATT"
    assert values(lambda c: B.mismatches(c, primer), [exact, "TT" + exact[2:], "GT"]) == [0, 1, None]
    assert values(lambda c: B.starts_like(c, primer), [exact, "AAA" + exact[3:], "GT"]) == [True, False, False]
    assert values(lambda c: B.find_approx(c, "ACGT", 1), ["TTACGTT", "TTACCTT", "GGGG", "AC"]) == [2, 2, -1, -1]
    assert values(B.phred, ["!I"]) == [[0, 40]]
    assert values(lambda c: B.passing_length(c, 1.0), [[0.4, 0.5, 0.2], [2.0], []], "a array<double>") == [2, 0, 0]


def test_lower_keys_keeps_the_last_spelling(spark):
    entries = [F.lit(v) for v in ("Host ", "a", "age", "1", "HOST", "b", "host", "c", " AGE", "2", "sex", "f")]
    df = spark.range(1).select(F.create_map(*entries).alias("m"), F.create_map(F.lit(" A"), F.lit("x"), F.lit("b"), F.lit(None).cast("string")).alias("u"), F.lit(None).cast("map<string,string>").alias("n"))
    got = df.select(S.lower_keys(F.col("m")), S.lower_keys(F.col("u")), S.lower_keys(F.col("n"))).first()
    assert tuple(got) == ({"host": "c", "age": "2", "sex": "f"}, {"a": "x", "b": None}, None)
