"""Readers and writers of the file formats that annotations, sequences and alignments come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """Tab-separated values with # comments."""
    return spark.read.option("sep", "\t").option("comment", "#").option("header", header).option("nullValue", "NA").schema(schema).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id (the first word of a header) and seq, lines put together."""
    records = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    return records.select(F.split(F.trim(lines[0]), r"\s+")[0].alias("id"), F.array_join(F.slice(lines, F.lit(2), F.size(lines)), "").alias("seq"))


def write_fasta(seqs: DataFrame, path: str, width: int = 60) -> None:
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    seqs.select(F.concat(F.lit(">"), "id", F.lit("\n"), wrapped).alias("value")).write.mode("overwrite").text(path)


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """aln_id (of the ID or AC tag, else none), row_id and seq of the rows of all records under path; a row that goes on in later lines is joined.

    Files are split where a record ends, so a record is one row of text, as it is when written.
    """
    records = spark.read.option("lineSep", "\n//").text(path).select(F.monotonically_increasing_id().alias("record"), F.regexp_replace("value", "\r", "").alias("value"))
    name = F.coalesce(F.nullif(F.regexp_extract("value", r"(?m)^#=GF\s+ID\s+(\S+)", 1), F.lit("")), F.nullif(F.regexp_extract("value", r"(?m)^#=GF\s+AC\s+(\S+)", 1), F.lit("")))
    lines = records.select("record", name.alias("aln_id"), F.posexplode(F.split("value", "\n")).alias("at", "line")).filter("trim(line) <> '' AND NOT startswith(line, '#') AND NOT startswith(line, '//')")
    parts = F.split(F.trim("line"), r"\s+", 2)
    rows = lines.select("record", "aln_id", "at", parts[0].alias("row_id"), F.replace(parts[1], F.lit(" "), F.lit("")).alias("part"))
    joined = rows.groupBy("record", "aln_id", "row_id").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
    return joined.select("aln_id", "row_id", F.array_join("parts.part", "").alias("seq"))


def read_aligned_fasta(spark: SparkSession, path: str) -> DataFrame:
    """row_id, turned and seq of an aligned FASTA: names without the _R_ that says a row was reverse-complemented, gaps as -."""
    rows = read_fasta(spark, path)
    return rows.select(F.regexp_replace("id", "^_R_", "").alias("row_id"), F.col("id").startswith("_R_").alias("turned"), F.translate(F.upper("seq"), "._~", "---").alias("seq"))


def write_records(records: DataFrame, path: str) -> None:
    """Stockholm records(aln_id, record) as text, partitioned by nothing and each whole in one file; an earlier output is replaced."""
    records.select(F.regexp_replace("record", "\n$", "").alias("value")).write.mode("overwrite").text(path)


def stockholm(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """aln_id, record: rows(aln_id, row_id, seq) under ordered tags(aln_id, place, tag, value), with an RF line under tag RF.

    Rows of one alignment must be equally wide.
    """
    wide = Window.partitionBy("aln_id")
    padded = rows.withColumn("pad", F.max(F.char_length("row_id")).over(wide) + 2).withColumn("lo", F.min(F.char_length("seq")).over(wide)).withColumn("hi", F.max(F.char_length("seq")).over(wide))
    line = F.concat(F.rpad("row_id", F.col("pad").cast("int"), F.lit(" ")), F.when(F.col("lo") == F.col("hi"), F.col("seq")).otherwise(F.raise_error(F.lit("alignment rows differ in width"))))
    body = padded.groupBy("aln_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("body"))
    gf = F.concat(F.lit("#=GF "), "tag", F.lit("   "), "value")
    head = tags.filter("tag <> 'RF'").groupBy("aln_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", gf.alias("line")))), lambda x: x["line"]), "\n").alias("head"))
    rf = tags.filter("tag = 'RF'").select("aln_id", F.concat(F.lit("\n#=GC RF  "), "value").alias("rf"))
    joined = body.join(head, "aln_id", "left").join(rf, "aln_id", "left")
    return joined.select("aln_id", F.concat(F.lit("# STOCKHOLM 1.0\n"), F.coalesce("head", F.lit("")), F.lit("\n"), "body", F.coalesce("rf", F.lit("")), F.lit("\n//\n")).alias("record"))


def lint_codes(lines: DataFrame) -> DataFrame:
    """packet, severity, code from a checker's lines (packet, value) such as ``ERROR [E12] text``."""
    found = lambda i: F.regexp_extract("value", r"^\s*(ERROR|WARN|INFO)\s+\[?([A-Z]+-?\d+)\]?", i)
    return lines.select("packet", found(1).alias("severity"), found(2).alias("code")).filter("code <> ''")


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, size of a file of chromosome sizes."""
    return spark.read.option("sep", "\t").schema("chrom string, size bigint").csv(path)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """member, n_full_len, genomic_bp, cov, div_median, frac_tandem of a Parquet table; a column that it lacks is null."""
    raw = spark.read.parquet(path)
    names = {"n_full_len": "n_full_len", "genomic_bp": "genomic_bp", "cov": "cov_ge3", "div_median": "div_median", "frac_tandem": "frac_tandemtool"}
    own = [(F.col(old) if old in raw.columns else F.lit(None)).cast("double").alias(new) for new, old in names.items()]
    return raw.select(F.concat_ws(":", "tool", "family").alias("member"), *own)


def read_consensus(lines: DataFrame) -> DataFrame:
    """kimura and seq of a consensus file's lines(value): the header's mean divergence, and what follows without gaps."""
    header = F.regexp_extract("value", r"Avg Kimura = ([0-9.]+)", 1).try_cast("double")
    body = F.when(~F.col("value").startswith(">") & ~F.col("value").startswith("#"), F.translate(F.trim("value"), ".-", ""))
    rows = lines.withColumn("at", F.monotonically_increasing_id())
    return rows.agg(F.max(header).alias("kimura"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce(body, F.lit("")).alias("b")))), lambda x: x["b"]), "").alias("seq"))


def read_blast(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Tabular alignments with the columns asked for."""
    return spark.read.option("sep", "\t").schema(columns).csv(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A map of classification paths under # comments and a header."""
    return spark.read.option("sep", "\t").option("comment", "#").option("header", True).csv(path)


def read_vocabulary(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """canonical_path of a vocabulary, and the version its comments name, or unknown."""
    named = spark.read.text(path).select(F.regexp_extract("value", r"^#\s*vocabulary_version:\s*(.*?)\s*$", 1).alias("v")).filter("v <> ''").head()
    paths = read_mapping(spark, path).select(F.trim("canonical_path").alias("canonical_path")).filter("canonical_path <> ''").distinct()
    return paths, named[0] if named else "unknown"


#: What is read of a packet; further parts are left alone.
ENGINE = "struct<error:string,rebuilt_consensus_len:double,alignment_rows:bigint,median_depth:double,lint:struct<genome:struct<n_error:bigint,n_coord_warnings:bigint>,coord_check:struct<n_verified:bigint,n_rows:bigint>>>"
PACKET = f"cluster_id bigint, cluster_key string, mode string, canonical_path string, tp string, tp_status string, n_loci bigint, n_loci_full bigint, modal_consensus_len double, model_index bigint, model_centre double, n_models bigint, error string, engines map<string,{ENGINE}>"


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """One row for each packet and engine of the JSON files under a path, whole clusters and models alike; those with errors, without engines or that can't be read are left out."""
    raw = spark.read.schema(PACKET).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "packet.json").json(path)
    good = raw.filter("error IS NULL AND engines IS NOT NULL AND size(engines) > 0")
    folder = F.regexp_extract(F.input_file_name(), r"/(model[^/]*)/packet\.json$", 1)
    rows = good.withColumn("model_dir", folder).select(
        "cluster_id", "cluster_key", "mode", "canonical_path", "tp", "tp_status", "n_loci", "n_loci_full", F.col("modal_consensus_len").alias("modal_cons"),
        F.coalesce("model_index", F.lit(0)).alias("model_index"), "model_centre", F.coalesce("n_models", F.lit(1)).alias("n_models"), "model_dir", F.explode("engines").alias("engine", "x"),
    )
    depth = F.when(F.coalesce("canonical_path", F.lit("")) == "", 0).otherwise(F.size(F.split("canonical_path", ":")))
    return rows.select(
        *[c for c in rows.columns if c != "x"], depth.alias("path_depth"), F.col("x.error").alias("engine_error"), F.col("x.rebuilt_consensus_len").alias("cons"), F.col("x.alignment_rows").alias("rows"), F.col("x.median_depth").alias("depth"),
        F.col("x.lint.genome.n_error").alias("lint_err"), F.col("x.lint.genome.n_coord_warnings").alias("coord_warn"), F.col("x.lint.coord_check.n_verified").alias("verified"), F.col("x.lint.coord_check.n_rows").alias("n_rows"),
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, length and sha256 (lower-case hex) of each file under a path that isn't empty; a file is a value, so of up to 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def write_edges(edges: DataFrame, path: str) -> None:
    edges.write.mode("overwrite").parquet(path)


def write_json(rows: DataFrame, path: str) -> None:
    """A JSON object a line; nested columns stay nested."""
    rows.write.mode("overwrite").json(path)


def write_mapping(mapping: DataFrame, path: str, version: str, comments: tuple[str, ...] = ()) -> None:
    """A map under comments that tell its version, when it was made (UTC) and what its columns are."""
    columns = ["canonical_path", "tp", "scheme_version", "source_url", "status", "tp_long", "note"]
    spark = mapping.sparkSession
    made = spark.sql("SELECT date_format(to_utc_timestamp(current_timestamp(), current_timezone()), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").head()[0]
    head = [f"#tp_map_version: {version}", f"#generated: {made}", *[f"# {c}" for c in comments], "\t".join(columns)]
    body = mapping.select(F.lit(1).alias("part"), "canonical_path", F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))
    top = spark.createDataFrame([(0, str(i).zfill(6), line) for i, line in enumerate(head)], "part int, canonical_path string, value string")
    # a map has a row for each path of a vocabulary; one file keeps the comments above them
    top.unionByName(body).coalesce(1).sortWithinPartitions("part", "canonical_path").select("value").write.mode("overwrite").text(path)


def write_coverage(used: DataFrame, path: str) -> None:
    """scope, canonical_path, n, status in their order."""
    used.select("scope", "canonical_path", "n", "status").orderBy("scope", "canonical_path").write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
