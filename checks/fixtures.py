"""Study tables derived from the given tables, in SQL both engines accept."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes, SparseGenotypes

BASE = ["customer", "orders", "lineitem", "part"]

VIEWS = {
    "person": "select c_custkey as person_id from customer",
    "cb_search_person": """
        select c_custkey as person_id,
          case when c_custkey%10<>9 then 1 else 0 end as has_ehr_data,
          case when c_custkey%7<>6 then 1 else 0 end as has_whole_genome_variant
        from customer""",
    "flagged_samples": "select c_custkey as sample_id from customer where c_custkey%23=0",
    "more_flagged_samples": "select c_custkey as sample_id from customer where c_custkey%23=0 or c_custkey%17=1",
    "condition_occurrence": """
        select o_custkey as person_id,
          case when o_orderkey%60=0 then 432510 when o_orderkey%60=1 then 374919
               else 300000+o_orderkey%60 end as condition_concept_id
        from orders""",
    "variants": """
        select 'chr'||cast(1+p_partkey%22 as varchar(3)) as contig,
          cast(10000+37*floor(p_partkey/22) as int) as position,
          substr('ACGT',cast(1+p_partkey%4 as int),1) as ref,
          substr('ACGT',cast(1+(p_partkey+1+p_size%3)%4 as int),1) as alt,
          p_partkey as variant_id
        from part""",
    "calls": """
        select cast(o_custkey as varchar(20)) as s, l_partkey as variant_id,
          case g when 3 then null when 2 then 1 else 0 end as a1,
          case g when 3 then null when 0 then 0 else 1 end as a2
        from (select o_custkey, l_partkey, l_linenumber%4 as g,
                row_number() over (partition by o_custkey,l_partkey
                  order by l_orderkey,l_linenumber,l_suppkey,l_extendedprice,l_quantity) as rn
              from lineitem join orders on l_orderkey=o_orderkey) t
        where rn=1""",
    "models": "select * from (values ('PGSA',3),('PGSB',2),('PGSC',7)) as m(prs_id,k)",
    "raw_weights": """
        select m.prs_id,
          case when p_partkey%97=5 then 'Un'
               when p_partkey%2=0 then cast(1+p_partkey%22 as varchar(3))
               else 'chr'||cast(1+p_partkey%22 as varchar(3)) end as hm_chr,
          case when p_partkey%89=7 then 'NA'
               when p_partkey%11=0 then cast(v.position as varchar(12))||'.0'
               else cast(v.position as varchar(12)) end as hm_pos,
          case when p_partkey%79=3 then ' ' when p_partkey%5=0 then v.ref
               when p_partkey%5<4 then v.alt else 'N' end as effect_allele,
          case when p_partkey%83=2 then 'x'
               else cast((p_size-25)/64.0 as varchar(20)) end as effect_weight
        from part join variants v on v.variant_id=p_partkey cross join models m
        where p_partkey%m.k=0
        union all
        select 'PGSA','chr'||cast(1+p_partkey%22 as varchar(3)), cast(v.position as varchar(12)), v.alt, '0.5'
        from part join variants v on v.variant_id=p_partkey where p_partkey%30=0""",
    "reference_blocks": """
        select cast(o_custkey as varchar(20)) as s,
          'chr'||cast(1+l_partkey%22 as varchar(3)) as contig,
          cast(10000+100000*l_linenumber as int) as start_pos,
          cast(10000+100000*l_linenumber+1000*l_quantity-1 as int) as end_pos
        from lineitem join orders on l_orderkey=o_orderkey""",
    "phecode_counts": """
        select o_custkey as person_id, 'PH_'||cast(o_orderkey%12 as varchar(2)) as phecode,
          count(*) as n
        from orders group by o_custkey, o_orderkey%12""",
    "numbered_counts": """
        select o_custkey as person_id, cast(cast(200+floor(o_orderkey%12/4) as int) as varchar(3))||'.'||cast(o_orderkey%4 as varchar(1)) as phecode,
          count(*) as n
        from orders group by o_custkey, o_orderkey%12, o_orderkey%4""",
    "phecode_definitions": """
        select phecode, case substr(phecode,5,1) when '1' then 'Male' when '2' then 'Female' else 'Both' end as sex,
          phecode as exclude_first, substr(phecode,1,4)||case substr(phecode,5,1) when '0' then '1' else substr(phecode,5,1) end as exclude_last
        from (select distinct phecode from numbered_counts) t""",
    "phewas_cohort": """
        select c_custkey as person_id,
          case when c_custkey*7%11<3 then 1 else 0 end as sv_status,
          c_custkey%2 as sex_code, c_nationkey+20 as age_at_last_event,
          c_acctbal/1000.0 as pc1
        from customer""",
}

# The first line item of a person and variant, by partial minimum instead of sorting all of them.
# Line numbers are below 1,000; further sort columns could only separate equal line numbers.
SPARK_VIEWS = {
    **VIEWS,
    "calls": """
        select cast(o_custkey as varchar(20)) as s, l_partkey as variant_id,
          case g when 3 then null when 2 then 1 else 0 end as a1,
          case g when 3 then null when 0 then 0 else 1 end as a2
        from (select o_custkey, l_partkey, min(l_orderkey*1000+l_linenumber)%1000%4 as g
              from lineitem join orders on l_orderkey=o_orderkey
              group by o_custkey, l_partkey) t""",
}

CONCEPTS = [432510, 374919]
SEED = 2025
SAMPLE_SIZE = 20


def needed_views(sql: str, views: dict[str, str]) -> list[str]:
    """Names of the views ``sql`` uses, directly or not, in order of definition."""
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in views.keys() & words - wanted:
            wanted.add(name)
            pending.append(views[name])
    return [name for name in views if name in wanted]


class Study:
    """The derived tables of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            views = needed_views(SPARK_VIEWS[name], SPARK_VIEWS)
            text = " ".join([SPARK_VIEWS[name], *[SPARK_VIEWS[v] for v in views]])
            given = {b: self.base(b) for b in BASE if re.search(rf"\b{b}\b", text)}
            steps = [f"{b} as (select * from {{{b}}})" for b in given] + [f"{v} as ({SPARK_VIEWS[v]})" for v in views]
            self._tables[name] = self.spark.sql(f"with {', '.join(steps)} {SPARK_VIEWS[name]}", **given)
        return self._tables[name]

    def variants(self) -> DataFrame:
        return self.table("variants").select(
            "variant_id", "contig", "position", F.array("ref", "alt").alias("alleles")
        )

    def samples(self) -> DataFrame:
        return self.table("person").select(F.col("person_id").cast("string").alias("s"))

    def genotypes(self) -> Genotypes:
        return Genotypes(self.samples(), self.variants(), self.table("calls"))

    def sparse_genotypes(self) -> SparseGenotypes:
        return SparseGenotypes(
            self.samples(), self.variants(), self.table("calls"), self.table("reference_blocks")
        )

    def manifest(self) -> DataFrame:
        """Model list, with one model lacking weights and one whose loci match nothing."""
        rows = [(m, f"{m}.txt.gz", "Ischemic Stroke") for m in ("PGSA", "PGSB", "PGSC", "PGSX", "PGSY")]
        return self.spark.createDataFrame(rows, "id string, url string, phenotype string")
