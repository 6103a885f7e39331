"""Site and expression relations derived from the driver's order tables, which hold no
motif data. The text is accepted unchanged by Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_GENE = "concat('G', lpad(cast(l_partkey % 200 as string),4,'0'))"
_LINE = "case l_suppkey % 5 when 0 then 'IM62' when 1 then 'IM155' when 2 then 'IM502' when 3 then 'IM664' else 'IM767' end"
_BASES = "'0123456789abcdef','ACGTACGTACGTACGT'"
REFERENCE_LINE = "IM767"
LINES = ("IM155", "IM502", "IM62", "IM664", "IM767")

SITES_RAW = f"""
select gene_id, line, original_motif_id, start_pos, start_pos + length(base) - 1 as end_pos, strand, score,
  case when l_orderkey % 3 = 0 then concat(substr(base,1,mp-1), translate(substr(h,1,1),{_BASES}), substr(base,mp+1)) else base end as sequence,
  src_ord
from (
  select l_orderkey, h, base, mp, src_ord, {_GENE} as gene_id, {_LINE} as line,
    concat(cast(pat + 1 as string), '-', base) as original_motif_id,
    cast((l_orderkey*7 + l_linenumber*3 + l_suppkey) % 1000 as int) + 1 as start_pos,
    case when l_linenumber % 2 = 0 then '-' else '+' end as strand,
    cast((l_orderkey*31 + l_linenumber*17) % 1000 as double) / 50 as score
  from (
    select l.*,
      concat_ws('|', lpad(cast(l_orderkey as string),9,'0'), cast(l_linenumber as string), lpad(cast(l_partkey as string),7,'0'),
                lpad(cast(l_suppkey as string),6,'0'), lpad(cast(cast(round(l_extendedprice*100) as bigint) as string),12,'0')) as src_ord,
      cast(l_partkey % 60 as int) as pat,
      md5(cast(l_orderkey*8 + l_linenumber as string)) as h,
      cast(l_orderkey % 8 as int) + 1 as mp,
      translate(substr(md5(concat('m', cast((l_partkey % 60) % 25 as string))), 1, cast(8 + (l_partkey % 60) % 4 as int)),{_BASES}) as base
    from lineitem l
    where (l_partkey % 200 + 3*(l_partkey % 60) + 5*(l_suppkey % 5)) % 11 < 8
  ) a
) b
"""

EXPRESSION_LONG = f"""
select gene as gene_id, line, round(log2(v / max(case when line = '{REFERENCE_LINE}' then v end) over (partition by gene)), 6) as expression
from (select {_GENE} as gene, {_LINE} as line, sum(l_extendedprice) as v from lineitem group by 1, 2) t
"""


def sites_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SITES_RAW.replace("from lineitem l", "from {lineitem} l"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def expression_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EXPRESSION_LONG.replace("from lineitem", "from {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))

#: Motif records, as discovery tools list them: one a line and pattern.
MOTIFS = """
select line, motif_id, consensus, cast(length(consensus) as int) as width, n_sites, cast(n_sites % 97 as double) / 1000 as evalue,
  cast(row_number() over (order by line, first_ord) as int) as ord
from (select line, regexp_replace(original_motif_id, '^[^-]*-', '') as consensus, min(original_motif_id) as motif_id, count(*) as n_sites, min(src_ord) as first_ord
      from sites_raw group by 1, 2) t
"""


def motif_records(sites: DataFrame) -> DataFrame:
    return sites.sparkSession.sql(MOTIFS.replace("from sites_raw", "from {sites_raw}"), sites_raw=sites)
