"""Classification of taxa, samples, hosts, units and diseases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .rules import blank, bucket, case_when, exactly_one, matches, strip_negations, strip_pattern
from .text import nonblank, trim_ws


def host_of(host: Column, sample_type: Column, hint: Column) -> Column:
    """Explicit host, host named in the sample type, positive environmental evidence, paper hint, unknown."""
    named = F.nullif(bucket(sample_type, V.HOSTS, "", ""), F.lit(""))
    environment = F.nullif(bucket(sample_type, V.ENVIRONMENTS, "", ""), F.lit(""))
    return F.when(~blank(host), bucket(host, V.HOSTS)).otherwise(
        F.coalesce(named, environment, nonblank(hint), F.lit("Not recorded"))
    )


def synonym(c: Column, table: dict[str, str]) -> Column:
    """Canonical spelling by exact lower-cased lookup, NULL when the value is not in the table."""
    low = F.lower(trim_ws(c))
    entries = [x for pair in table.items() for x in (F.lit(pair[0]), F.lit(pair[1]))]
    return F.try_element_at(F.create_map(*entries), low)


def normalise_disease(c: Column, synonyms: dict[str, str] = V.DISEASE_SYNONYMS,
                      undefined: list[str] = V.UNDEFINED_ABBREVIATIONS) -> Column:
    """struct(name, how): synonyms merged, undefined abbreviations verbatim, else first letter upper."""
    raw = F.coalesce(trim_ws(c), F.lit(""))
    known = synonym(raw, synonyms)
    verbatim = F.concat(F.upper(F.substring(raw, 1, 1)), F.substring(raw, 2, 1 << 30))
    code = F.lower(raw).isin(undefined)
    name = F.coalesce(known, F.when(code, raw).otherwise(verbatim))
    how = case_when(
        [(raw == "", F.lit("")), (known.isNotNull(), F.lit("merged synonym")),
         (code, F.lit("verbatim (abbreviation undefined in source)"))],
        F.lit("verbatim"),
    )
    return F.struct(name.alias("name"), how.alias("how"))


def drop_clauses(c: Column, pattern: str = V.KEPT_APART_CLAUSE) -> Column:
    """Drop the ``;``/``|`` clauses that match; when none is left the text stays as it was."""
    keep = F.filter(F.split(c, "[;|]"), lambda part: ~F.coalesce(part.rlike("(?i)" + pattern), F.lit(False)))
    return F.when(F.size(keep) > 0, F.array_join(keep, "; ")).otherwise(c)


def paper_domain(c: Column) -> Column:
    """Domain a whole matrix states for itself; three or more kinds named resolve nothing."""
    low = strip_pattern(F.lower(drop_clauses(c)), V.PAPER_NEGATED_DOMAIN)
    kinds: dict[str, list[str]] = {}
    for stem, kind in V.DOMAIN_NOUN_KINDS:
        kinds.setdefault(kind, []).append(stem)
    named = sum((matches(low, "|".join(stems)).cast("int") for stems in kinds.values()), F.lit(0))
    return F.when(named >= 3, F.lit("Unclassified")).otherwise(bucket(low, V.PAPER_DOMAINS, "Unclassified"))


def unit_bucket(c: Column) -> Column:
    """Abundance unit with negated terms taken out first."""
    low = strip_pattern(F.lower(c), rf"({V.NORMALISATION_TERM})\s*(status|state)\b[^;.)]*?\b(not|un)\w*")
    return bucket(strip_negations(low, V.NORMALISATION_TERM), V.UNITS)


def disease_bucket(c: Column) -> Column:
    """Status text of one sample folded into a few classes."""
    low = F.lower(trim_ws(c))
    branches = [(blank(c), F.lit("Not recorded"))]
    for label, pattern, also in V.DISEASE_STATUS:
        cond = low.rlike(pattern)
        branches.append((cond & low.rlike(also) if also else cond, F.lit(label)))
    return case_when(branches, F.lit("Other label"))


def suffix_rank(c: Column, suffixes: list[tuple[str, str]] = V.VIRAL_SUFFIX_RANKS) -> Column:
    """Rank stated by the name's suffix, NULL when it states none."""
    low = F.lower(trim_ws(c))
    return case_when([(low.endswith(s), F.lit(rank)) for s, rank in suffixes], F.lit(None).cast("string"))


ictv_rank = suffix_rank


def clean_taxon(c: Column) -> Column:
    """``k__Bacteria(99)`` -> ``Bacteria``."""
    v = F.regexp_replace(trim_ws(c), r"^[a-z]?_{1,2}", "")
    v = F.regexp_replace(v, r"^D_\d+__", "")
    return trim_ws(F.regexp_replace(v, r"\(\d+(\.\d+)?\)\s*$", ""))


def known_taxon(c: Column) -> Column:
    """Cleaned name, NULL for blank cells and for words that mean 'no assignment'."""
    name = clean_taxon(c)
    return F.when(~F.lower(name).isin("", *V.UNKNOWN_TAXON_WORDS), name)


def feature_domain(c: Column) -> Column:
    """Domain a feature cell states: exactly one may match, otherwise NULL."""
    low = F.lower(clean_taxon(c))
    stated = F.when(~low.isin("", *V.UNKNOWN_DOMAIN_WORDS), strip_pattern(low, V.CELL_NEGATED_DOMAIN))
    return exactly_one(stated, V.FEATURE_DOMAINS)


def table_domain(c: Column) -> Column:
    """struct(domain, evidence) of a taxon string; without positive evidence the answer is 'unknown'."""
    text = F.coalesce(c, F.lit(""))
    virus = F.regexp_extract(text, "(?i)" + V.VIRUS_TEXT, 0)
    prokaryote = F.regexp_extract(text, "(?i)" + V.PROKARYOTE_TEXT, 0)
    domain = case_when([(virus != "", F.lit("virus")), (prokaryote != "", F.lit("prokaryote"))], F.lit("unknown"))
    evidence = case_when(
        [(virus != "", F.concat(F.lit("matched virus pattern '"), virus, F.lit("'"))),
         (prokaryote != "", F.concat(F.lit("matched prokaryote pattern '"), prokaryote, F.lit("'")))],
        F.lit("no virus or prokaryote keyword matched"),
    )
    return F.struct(domain.alias("domain"), evidence.alias("evidence"))


def sample_flags(sample_id: Column, source_file: Column) -> Column:
    """struct(control, assay): marks only, a flagged sample is never dropped here."""
    control = F.when(matches(sample_id, V.CONTROL_SAMPLE, True), F.lit("blank_or_control")).otherwise(F.lit(""))
    text = F.concat_ws(" ", sample_id, source_file)
    hint = F.upper(F.regexp_extract(text, "(?i)" + V.SEQUENCING_HINT, 1))
    return F.struct(control.alias("control"), hint.alias("assay"))


def split_taxonomy(c: Column) -> Column:
    """struct of seven ranks out of a lineage string; text of one bare token says nothing about its rank."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "[;|]"), lambda p: trim_ws(p))
    prefix = r"(?i)^([dkpcofgs])__\s*(.*)$"
    tagged = F.filter(parts, lambda p: p.rlike(prefix))
    bare = F.filter(parts, lambda p: ~p.rlike(prefix) & (p != ""))

    def last_tagged(rank: str) -> Column:
        letters = "".join(letter for letter, r in V.RANK_LETTERS.items() if r == rank)
        mine = F.filter(tagged, lambda p: p.rlike(rf"(?i)^[{letters}]__"))
        return trim_ws(F.regexp_extract(F.coalesce(F.try_element_at(mine, F.lit(-1)), F.lit("")), prefix, 2))

    by_prefix = [last_tagged(rank) for rank in V.LINEAGE_RANKS]
    positional = (F.size(bare) >= 2) & (F.concat(*by_prefix) == "")
    fields = []
    for i, rank in enumerate(V.LINEAGE_RANKS):
        place = F.coalesce(F.try_element_at(bare, F.lit(i + 1)), F.lit(""))
        fields.append(F.when(positional, place).otherwise(by_prefix[i]).alias(rank))
    return F.struct(*fields)


def looks_taxonomic(c: Column) -> Column:
    """True where a value reads like a taxon."""
    return matches(c, V.TAXON_TEXT, True)


def branch_of(strategy: Column, source: Column, selection: Column) -> Column:
    """struct(branch, why) of a library from its three archive fields."""
    s, src, sel = (F.upper(F.coalesce(trim_ws(c), F.lit(""))) for c in (strategy, source, selection))

    def dash(c: Column) -> Column:
        return F.when(c == "", F.lit("-")).otherwise(c)

    amplicon = (s == "AMPLICON") | sel.contains("AMPLICON")
    rna = (s == "RNA-SEQ") | src.contains("TRANSCRIPTOMIC") | F.array_contains(F.split(src, r"\s+"), "RNA")
    wgs = s.isin("WGS", "WGA")
    viral = src.contains("VIRAL") | F.greatest(*[sel.contains(h) for h in V.VIRAL_SELECTION])
    branch = case_when(
        [(amplicon, F.lit("amplicon")), (rna, F.lit("rna")), (wgs & viral, F.lit("dna_virome")),
         (wgs & src.contains("METAGENOMIC"), F.lit("dna_shotgun")),
         (wgs & src.contains("GENOMIC"), F.lit("unsupported_isolate_genome"))],
        F.lit("unresolved"),
    )
    why = F.concat(F.lit("strategy="), dash(s), F.lit(", source="), dash(src), F.lit(", selection="), dash(sel))
    return F.struct(branch.alias("branch"), why.alias("why"))


def branch_of_marker(marker: Column) -> Column:
    """Branch of a marker measured on the reads."""
    name = F.regexp_replace(F.coalesce(marker, F.lit("")), "^primer_like_", "")
    pairs = [x for k, v in V.MARKER_BRANCHES.items() for x in (F.lit(k), F.lit(v))]
    return F.when(name == "", F.lit("unresolved")).otherwise(
        F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit("amplicon_other"))
    )


def targets_of(strategy: Column, source: Column, target: Column) -> Column:
    """struct(usable_for, not_usable_for) of a library."""
    s, src = F.upper(F.coalesce(strategy, F.lit(""))), F.upper(F.coalesce(source, F.lit("")))
    rows = [
        ((s == "AMPLICON") & F.coalesce(target.startswith("ITS"), F.lit(False)), "fungal ITS abundance", "no bacteria, no viruses"),
        (s == "AMPLICON", "bacterial/archaeal 16S abundance", "no viral abundance, no fungi"),
        (src.contains("METATRANSCRIPTOMIC"), "expressed taxa / RNA viruses", "not comparable with DNA abundance"),
        (s.isin("WGS", "WGA") & src.contains("METAGENOMIC"), "bacterial + viral abundance from DNA shotgun",
         "viral fraction is bulk-derived, prophage-biased"),
    ]
    return F.struct(
        case_when([(c, F.lit(a)) for c, a, _ in rows], F.lit("unknown")).alias("usable_for"),
        case_when([(c, F.lit(b)) for c, _, b in rows], F.lit("assay not resolved")).alias("not_usable_for"),
    )


def scope_match(scope: Column, host: Column) -> Column:
    """True when every ``;`` group of the scope has a ``|`` alternative that occurs in the host text."""
    low = F.lower(F.coalesce(host, F.lit("")))
    groups = F.filter(F.split(F.lower(scope), ";"), lambda g: trim_ws(g) != "")
    return F.forall(
        groups, lambda g: F.exists(F.split(g, r"\|"), lambda w: (trim_ws(w) != "") & low.contains(trim_ws(w)))
    )
