"""Domain hits, tiers, triage, selection, rank statistics, phase enrichment, vocabulary checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.operators.permutation import average_ranks, correlation

#: Core profiles by kind, the first kind of which a pattern is found in the name (fixed values).
DOMAIN_KINDS = {
    "RT": (r"RVT_\d+$", r"RVT_N$", r"Pao_retrotransp$", r"RT_RNaseH", r"Exo_endo_phos", r"TERT$", r"RVP", r"Peptidase_A17$"),
    "transposase": (
        r"DDE_Tnp_", r"DDE_\d+$", r"Transposase_(?!22$)\d+$", r"Dimer_Tnp_hAT$", r"DBD_Tnp_", r"MULE$", r"Mutator", r"Plant_tran$", r"Tnp_P_element",
        r"HTH_Tnp_Tc3_", r"HTH_Tnp_Tc5$", r"Transp_Tc5_C$", r"HTH_Tnp_4$", r"HTH_48$", r"zf-Tnp_2$", r"Helitron_like_N$", r"Rol_Rep_N$", r"Replitron_HUH$", r"Rep_3$",
    ),
    "integrase": (r"^rve", r"Integrase_H2C2$", r"IN_DBD_C$"),
}
#: Orders by classification path or TP, the first that is found (fixed values).
ORDERS = (("SINE", "SINE"), ("LINE", "LINE"), ("PLE", "PLE|Penelope"), ("DIRS", "DIRS"), ("LTR", "LTR"), ("RC", r"Helitron|RC\b|Rolling"), ("TIR", "TIR|DNA"))
#: Length floors of a whole element by order, the cap of short ones, and what a consensus asks for (fixed values).
FLOORS = {"LTR": 4000, "DIRS": 4000, "LINE": 2500, "RC": 3000, "DNA": 1100, "TIR": 1100, "PLE": 1200, "Helitron": 3000}
SINE_CAP = 700
MIN_COVERAGE = 0.5
MIN_ROWS = 10
MIN_DEPTH = 5
#: Names of tiers (fixed values).
TIERS = {
    "A": "A - autonomous (core domain + class size)",
    "B thin": "B - core domain, alignment too thin to trust",
    "B short": "B - core domain, short for class",
    "C": "C - accessory domain only (likely truncated)",
    "D": "D - oversized for class, no core domain (suspect chimera/rDNA)",
    "E": "E - non-autonomous at expected size (SINE)",
    "F": "F - too short for class (MITE/fragment scale)",
}


def domain_kind(profile: Column) -> Column:
    """RT, transposase or integrase for a core domain, else null."""
    out = None
    for kind, patterns in DOMAIN_KINDS.items():
        found = profile.rlike("|".join(f"(?:{x})" for x in patterns))
        out = F.when(found, kind) if out is None else out.when(found, kind)
    return out


def order_of_path(path: Column, tp: Column | None = None) -> Column:
    """The order that a path or its TP names; Unknown if none does."""
    text = F.concat_ws("|", F.coalesce(path, F.lit("")), F.coalesce(tp, F.lit("")) if tp is not None else F.lit(""))
    out = None
    for name, pattern in ORDERS:
        found = text.rlike(f"(?i){pattern}")
        out = F.when(found, name) if out is None else out.when(found, name)
    return out.otherwise("Unknown")


def path_order(path: Column) -> Column:
    """The fourth part of a classification path, else the second, else ``repeat``."""
    parts = F.split(path, ":")
    return F.coalesce(F.get(parts, F.lit(3)), F.get(parts, F.lit(1)), F.lit("repeat"))


def domain_summary(hits: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """hits(seq, profile, hmm_cov): profiles by number and name, core ones that cover enough of their profile, best coverage."""
    kind = F.when(F.col("hmm_cov") >= min_coverage, domain_kind(F.col("profile")))
    # one set a sequence, of which all else is told: sets of their own would each be shuffled, distinct counts each with all rows
    found = F.when(F.col("profile").isNotNull(), F.struct("profile", kind.alias("kind")))
    sets = hits.groupBy("seq").agg(F.collect_set(found).alias("found"), F.max("hmm_cov").alias("best_cov"))
    names = lambda x, c: F.array_sort(F.array_distinct(F.transform(x, lambda y: y[c])))
    core = F.filter("found", lambda x: x["kind"].isNotNull())
    rows = sets.select("seq", names("found", "profile").alias("all"), names(core, "kind").alias("kinds"), names(core, "profile").alias("core"), "best_cov")
    return rows.select(
        "seq", F.size("all").cast("bigint").alias("n_dom"), F.array_join(F.slice("all", 1, 12), ";").alias("domains"), F.size("core").cast("bigint").alias("n_core"),
        F.array_join("kinds", ";").alias("core_kinds"), F.array_join("core", ";").alias("core_domains"), "best_cov",
    )


def parse_domain_table(lines: DataFrame) -> DataFrame:
    """Whitespace-separated domain hits (value) by position, behind a column of hit ids; rows that are too short or not numbers are left out."""
    parts = F.split(F.trim("value"), r"\s+")
    number = lambda i, t: F.get(parts, F.lit(i)).try_cast(t)
    rows = lines.filter(~F.col("value").startswith("#")).select(
        F.get(parts, F.lit(1)).alias("seq"), F.get(parts, F.lit(3)).alias("profile"), number(5, "int").alias("hmm_len"), number(6, "int").alias("hmm_from"), number(7, "int").alias("hmm_to"), number(11, "double").alias("evalue"), F.size(parts).alias("n"),
    )
    rows = rows.filter("n >= 12").dropna(subset=["hmm_len", "hmm_from", "hmm_to", "evalue"])
    return rows.drop("n").withColumn("hmm_cov", F.try_divide(F.abs(F.col("hmm_to") - F.col("hmm_from")) + 1, F.col("hmm_len")))


def tier(order: Column, length: Column, n_dom: Column, n_core: Column, n_rows: Column, depth: Column) -> Column:
    """The tier's name, A to F; what is missing counts as 0."""
    floor = F.create_map(*[F.lit(x) for kv in FLOORS.items() for x in kv])[order]
    whole = F.coalesce(length >= floor, F.lit(False))
    n_dom, n_core, n_rows, depth = (F.coalesce(c, F.lit(0)) for c in (n_dom, n_core, n_rows, depth))
    thin = (n_rows < MIN_ROWS) | (depth < MIN_DEPTH)
    name = (
        F.when(order == "SINE", F.when(length > SINE_CAP, "D").otherwise("E"))
        .when((n_core > 0) & whole, F.when(thin, "B thin").otherwise("A")).when(n_core > 0, "B short").when(n_dom > 0, "C").when(whole, "D").otherwise("F")
    )
    return F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv])[name]


def triage(codes: DataFrame) -> DataFrame:
    """codes(packet, severity, code): packets and occurrences of each code."""
    return codes.groupBy("severity", "code").agg(F.count_distinct("packet").alias("packets"), F.count("*").alias("total"))


def with_errors(codes: DataFrame) -> DataFrame:
    """n_packets, n_with_errors: distinct packets, and those of which a code is an ERROR."""
    return codes.agg(F.count_distinct("packet").alias("n_packets"), F.count_distinct(F.when(F.col("severity") == "ERROR", F.col("packet"))).alias("n_with_errors"))


def tier_crosstab(tiers: DataFrame) -> DataFrame:
    """order_name with the number of models in each tier, A to F, 0 where there are none; tiers(order_name, tier)."""
    letter = F.substring("tier", 1, 1)
    return tiers.groupBy("order_name").agg(*[F.count_if(letter == x).alias(x.lower()) for x in "ABCDEF"], F.count("*").alias("total"))


def round_robin(rows: DataFrame, want: int, stratum: list[str], draw: Column, key: str) -> DataFrame:
    """``want`` rows dealt from strata in turn: each stratum numbered by draw, then by (number, stratum)."""
    number = F.row_number().over(Window.partitionBy(*stratum).orderBy(draw, key))
    # a row that is dealt has a number of ``want`` at most, so the rest need not be ordered
    return rows.withColumn("number", number).filter(F.col("number") <= want).orderBy("number", *stratum).limit(want)


def spearman(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    known = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_ranks(average_ranks(known, by, x, "rx"), by, y, "ry")
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), F.round(correlation(F.col("rx"), F.col("ry")), 6).alias("rho"))


def mann_whitney(rows: DataFrame, by: list[str], group: str, value: str) -> DataFrame:
    """U of group 1 against 0, and the rank-biserial effect."""
    ranked = average_ranks(rows, by, value, "r")
    sums = ranked.groupBy(*by).agg(F.count_if(F.col(group) == 1).alias("n1"), F.count_if(F.col(group) == 0).alias("n0"), F.sum(F.when(F.col(group) == 1, F.col("r"))).alias("r1"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    return sums.filter("n1 > 0 AND n0 > 0").select(*by, "n1", "n0", u.alias("u"), F.round(2 * u / (F.col("n1") * F.col("n0")) - 1, 6).alias("effect"))


def vocabulary_check(mapping: DataFrame, vocabulary: DataFrame, used: DataFrame) -> DataFrame:
    """Each path as mapped, accepted, used, and its status; a name that only begins like an accepted one isn't accepted."""
    flag = lambda df, name: df.select("path").filter("path IS NOT NULL").distinct().withColumn(name, F.lit(True))
    every = flag(mapping, "mapped").join(flag(vocabulary, "accepted"), "path", "full").join(flag(used, "used"), "path", "full").na.fill(False)
    status = F.when(F.col("mapped") & ~F.col("accepted"), "rejected").when(F.col("mapped"), "ok").when(F.col("used"), "missing").otherwise("unmapped")
    return every.withColumn("status", status)
