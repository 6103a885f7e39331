"""Readers of hit tables, motif files, expression tables, sequences and lists."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REQUIRED = ("motif_ID", "seq_ID", "site_Start", "site_End", "site_Strand", "site_Score", "site_Sequence")
MISSING = ("", "NaN", "nan")


def line_name(directory: Column) -> Column:
    """First ``IM<digits>``, else the name without every ``streme_``."""
    found = F.regexp_extract(directory, r"IM\d+", 0)
    return F.when(found != "", found).otherwise(F.replace(directory, F.lit("streme_")))


def line_number(directory: Column) -> Column:
    """Digits after IM, else the whole name."""
    found = F.regexp_extract(directory, r"IM(\d+)", 1)
    return F.when(found != "", found).otherwise(directory)


def _parent(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def _lines(spark: SparkSession, paths: str | list[str], separator: str | None = None) -> DataFrame:
    """(path, start, at, n, text): lines with a key that orders them within their file: where the
    block they were read from begins (start), then their place among the rows read (at); ``n`` is
    both as text. Large files are split as usual."""
    start, at = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    place = F.concat_ws("-", F.lpad(start.cast("string"), 15, "0"), F.lpad(at.cast("string"), 19, "0"))
    return spark.read.text(paths, lineSep=separator).select(F.col("_metadata.file_path").alias("path"), start.alias("start"), at.alias("at"), place.alias("n"), F.col("value").alias("text"))


def _tables_of(spark: SparkSession, pattern: str, lines: list[str]) -> list[str]:
    """The hit tables under the pattern that are of these lines. Runs are chosen here, by their
    directories: a test of the path beside the hits is made again for each hit."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = Path(pattern).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(Path(pattern))
    runs = spark.range(1).select(F.explode(F.array(*[F.lit(f.getPath().toString()) for f in found or []]).cast("array<string>")).alias("path"))
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", r[0]) for r in runs.where(line_name(_parent(F.col("path"))).isin(lines)).collect()]  # names, not patterns


def read_sites(spark: SparkSession, folder: str, lines: list[str] | None = None) -> DataFrame:
    """All runs' hits below ``folder``: children ``streme_*`` that hold ``sites.tsv``, which is
    a file or, for tables too large for one task, a folder of files in order of name.

    Columns are found by name in each file's header; a file that lacks one is left out.
    Blank and ``#`` lines go, as do rows with too few fields, a missing value or a
    number that is none. ``src_ord`` orders by directory, then file and line.
    """
    pattern = f"{folder.rstrip('/')}/streme_*/sites.tsv"
    chosen = _tables_of(spark, pattern, lines) if lines else [pattern]
    text = _lines(spark, chosen or pattern).where(F.lit(bool(chosen)) & (F.trim("text") != "") & ~F.col("text").startswith("#"))
    # The first line of each block as numbers, which need no sort; text only where it can be a header.
    named = F.when(reduce(and_, [F.col("text").contains(c) for c in REQUIRED]), F.col("text"))
    first = text.groupBy("path", "start", named.alias("header")).agg(F.min("at").alias("at")).groupBy("path").agg(F.min_by("header", F.struct("start", "at")).alias("header"))
    # What the path tells is found once a file, not once a row.
    in_folder = F.regexp_extract("path", r"/sites\.tsv/([^/]+)$", 1)
    first = first.withColumn("part", F.when(in_folder != "", in_folder)).withColumn("dir", F.regexp_extract("path", r"([^/]+)/sites\.tsv(?:/[^/]+)?$", 1)).withColumn("line", line_name(F.col("dir")))
    header = F.transform(F.split("header", "\t"), lambda c: F.trim(c))  # F.trim itself would be given the place too, as letters to trim
    good = first.where(F.forall(F.array(*[F.lit(c) for c in REQUIRED]), lambda c: F.array_contains(header, c)))
    # A row a file: small beside the hits, which would else meet by file, a file a task.
    rows = text.join(F.broadcast(good.select("path", "dir", "part", "line", *[(F.array_position(header, F.lit(c)) - 1).cast("int").alias(f"at_{c}") for c in REQUIRED])), "path")
    value = lambda c: F.trim(F.get("fields", F.col(f"at_{c}")))
    # An array of one, taken apart: the text is split once, not again for each field that is read.
    rows = rows.withColumn("fields", F.explode(F.array(F.split("text", "\t"))))
    rows = rows.where(F.size("fields") >= len(REQUIRED)).select("line", F.concat_ws("|", "dir", "part", "n").alias("src_ord"), *[value(c).alias(c) for c in REQUIRED])
    # The header goes with the rows whose numbers are none.
    kept = rows.where(reduce(and_, [F.col(c).isNotNull() & ~F.col(c).isin(*MISSING) for c in ("site_Start", "site_End", "site_Score", "site_Sequence", "motif_ID")]))
    whole = lambda c: F.expr(f"try_cast(try_cast({c} as double) as int)")
    return kept.select(
        F.col("seq_ID").alias("gene_id"), "line", F.col("motif_ID").alias("original_motif_id"), whole("site_Start").alias("start_pos"), whole("site_End").alias("end_pos"),
        F.col("site_Strand").alias("strand"), F.expr("try_cast(site_Score as double)").alias("score"), F.upper("site_Sequence").alias("sequence"), "src_ord",
    ).dropna(subset=["start_pos", "end_pos", "score"])


def read_motifs(spark: SparkSession, pattern: str, iupac_only: bool = False, pwm: bool = False) -> DataFrame:
    """Motif records of ``streme.txt`` files: one a MOTIF block.

    (line, ord, motif_id, consensus, width, n_sites, evalue[, pwm]); missing numbers are
    null. ``iupac_only`` keeps blocks whose consensus is in the alphabet alone.
    """
    files = spark.read.text(pattern, wholetext=True).select("value", _parent(F.col("_metadata.file_path")).alias("dir"))
    blocks = files.select("dir", F.posexplode(F.split("value", r"(?m)^(?=MOTIF\s)")).alias("n", "b")).where(F.col("b").rlike(r"^MOTIF\s+\S+"))
    head = r"^MOTIF\s+(?:\d+-)?(\S+)"
    number = lambda rx, kind: F.regexp_extract("b", rx, 1).try_cast(kind)
    out = blocks.select(
        line_name(F.col("dir")).alias("line"), F.concat_ws("|", "dir", F.lpad(F.col("n").cast("string"), 8, "0")).alias("ord_key"),
        F.regexp_extract("b", r"^MOTIF\s+(\S+)", 1).alias("motif_id"), F.regexp_extract("b", head, 1).alias("consensus"),
        number(r"\bw=\s*(\d+)", "int").alias("width"), number(r"nsites=\s*(\d+)", "int").alias("n_sites"), number(r"\bE=\s*([0-9.eE+-]+)", "double").alias("evalue"),
        *([_pwm(F.col("b")).alias("pwm")] if pwm else []),
    )
    if iupac_only:
        out = out.where(F.col("consensus").rlike("^[ACGTRYSWKMBDHVN]+$"))
    return out.withColumn("ord", F.row_number().over(Window.orderBy("ord_key"))).drop("ord_key")  # a row a motif


def _pwm(block: Column) -> Column:
    """Rows of four numbers after the matrix heading."""
    after = F.regexp_extract(block, r"(?s)letter-probability matrix:[^\n]*\n(.*)", 1)
    rows = F.transform(F.split(after, "\n"), lambda r: F.transform(F.split(F.trim(r), r"\s+"), lambda v: v.try_cast("double")))
    return F.filter(rows, lambda r: (F.size(r) == 4) & F.forall(r, lambda v: v.isNotNull()))


def motif_from_line(text: Column) -> Column:
    """struct<motif_id, consensus> of one MOTIF line; nulls if it is none."""
    hit = text.rlike(r"^MOTIF\s+\S+")
    return F.struct(F.when(hit, F.regexp_extract(text, r"^MOTIF\s+(\S+)", 1)).alias("motif_id"), F.when(hit, F.regexp_extract(text, r"^MOTIF\s+(?:\d+-)?(\S+)", 1)).alias("consensus"))


CONSOLIDATED = (
    "consolidated_motif_id string, original_motif_id string, motif_consensus string, original_streme_consensus string, line string, gene_id string, start_pos int, end_pos int, strand string, "
    "score double, sequence string, relative_position int, total_motifs_in_gene int, relative_position_fraction double, cluster_size int, merged_count int, length int"
)


def read_consolidated(spark: SparkSession, path: str, required: tuple[str, ...] = ("consolidated_motif_id", "line", "gene_id", "start_pos", "sequence")) -> DataFrame:
    """The consolidated table; columns by name, missing ones null, required ones checked."""
    table = spark.read.csv(path, sep="\t", header=True)
    lacking = [c for c in required if c not in table.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    wanted = [f.strip().split(" ") for f in CONSOLIDATED.split(",")]
    out = table.select(*[(F.col(n).try_cast(t) if n in table.columns else F.lit(None).cast(t)).alias(n) for n, t in wanted])
    return out.withColumn("src_ord", F.concat_ws("|", "consolidated_motif_id", "line", "gene_id", F.lpad(F.col("start_pos").cast("string"), 12, "0"), "strand", "sequence"))


def read_expression(spark: SparkSession, path: str, shape: str = "auto", reference: str | None = None, sep: str = "\t") -> DataFrame:
    """(gene_id, line, expression) of a long or wide table.

    ``auto`` calls it wide if it has over three columns and one begins with IM. In a wide
    table the first column is the gene and ``LRTadd`` is no line. ``reference`` drops
    that line.
    """
    table = spark.read.csv(path, sep=sep, header=True)
    wide = shape == "wide" or (shape == "auto" and len(table.columns) > 3 and any(c.startswith("IM") for c in table.columns))
    if wide:
        gene, lines = table.columns[0], [c for c in table.columns[1:] if c != "LRTadd" and (shape == "wide" or c.startswith("IM"))]
        out = table.select(F.col(gene).alias("gene_id"), *[F.col(c).try_cast("double").alias(c) for c in lines]).unpivot(["gene_id"], lines, "line", "expression")
    else:
        a, b, c = table.columns[:3]
        out = table.select(F.col(a).alias("gene_id"), F.col(b).alias("line"), F.col(c).try_cast("double").alias("expression"))
    return out if reference is None else out.where(F.col("line") != reference)


def read_expression_lenient(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Columns by any of their usual names; a missing value is 0; of repeated keys the
    last row wins."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "t"))
    header = spark.read.csv(path, sep=sep, header=True).columns
    at = lambda *names: next((header.index(x) for x in names if x in header), None)
    field = lambda i: F.lit(None).cast("string") if i is None else F.get(F.split("t", sep), F.lit(i))
    body = rows.where((F.col("n") > 0) & (F.trim("t") != ""))
    table = body.select("n", field(at("gene", "Gene", "gene_id")).alias("gene_id"), field(at("line", "Line")).alias("line"), F.coalesce(field(at("expression", "Expression", "value")).try_cast("double"), F.lit(0.0)).alias("expression"))
    return table.groupBy("gene_id", "line").agg(F.max_by("expression", "n").alias("expression"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, description, sequence): records of any number of lines, in files whose
    lines end with a line feed. ``ord`` orders by file, then place. Files are split
    between records; only a record is one string. What comes before a file's first
    record is left out.
    """
    rows = _lines(spark, path, separator="\n>")
    first = rows.groupBy("path").agg(F.min("n").alias("first"))
    starts = F.col("n") == F.col("first")
    records = rows.join(first, "path").where(~starts | F.col("text").startswith(">"))
    record = F.when(starts, F.substr("text", F.lit(2))).otherwise(F.col("text"))
    head = F.trim(F.regexp_extract("r", r"^([^\r\n]*)", 1))
    return records.select(F.concat_ws("|", "path", "n").alias("ord"), record.alias("r")).select(
        "ord", F.split(head, r"\s+")[0].alias("id"), head.alias("description"), F.regexp_replace(F.regexp_extract("r", r"(?s)^[^\n]*\n(.*)", 1), r"\s", "").alias("sequence")
    )


def read_motif_list(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated id, name, E-value, sites, width; ``#`` comments; short rows padded
    with nulls, rows under two fields left out."""
    f = F.split("value", "\t")
    known = lambda i: F.nullif(F.trim(F.get(f, F.lit(i))), F.lit("N/A"))
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).where(F.size(f) >= 2)
    return rows.select(known(0).alias("motif_id"), known(1).alias("name"), known(2).try_cast("double").alias("evalue"), known(3).try_cast("int").alias("n_sites"), known(4).try_cast("int").alias("width"))


COMPILED = (
    "all_motifs map<string,struct<consensus:string,width:int,line:string,evalue:double,sites:int>>, "
    "line_motifs map<string,array<struct<motif_id:string,consensus:string,evalue:double,width:int>>>, "
    "motif_positions map<string,array<struct<position:int,sequence:string,strand:string>>>"
)


def read_compiled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPILED).json(path, multiLine=True)


def read_genes(spark: SparkSession, path: str | None = None, text: str | None = None) -> DataFrame:
    """Gene ids of a file, one a line, or of a comma-separated text; blanks go."""
    if path is None:
        raw = spark.range(1).select(F.explode(F.split(F.lit(text or ""), ",")).alias("value"))
    else:
        raw = spark.read.text(path)
    return raw.select(F.trim("value").alias("gene_id")).where("gene_id <> ''")


def read_features(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A feature matrix; every column but the keys is a number."""
    table = spark.read.csv(path, sep=sep, header=True)
    names = {"gene": "gene_id", "Gene": "gene_id", "Line": "line"}
    keys = {"gene_id", "line", "gene_line_id"}
    return table.select(*[F.col(c).alias(n) if (n := names.get(c, c)) in keys else F.col(c).try_cast("double").alias(n) for c in table.columns])


def motif_counts(spark: SparkSession, pattern: str) -> DataFrame:
    """MOTIF lines a run file, and how many pairs the files make."""
    rows = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("path"))
    return rows.groupBy(_parent(F.col("path")).alias("run")).agg(F.count_if(F.col("value").startswith("MOTIF")).alias("n_motifs"))
