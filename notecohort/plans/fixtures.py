"""Clinical-shaped views over the driver's TPC-H-like test tables.

The test tables hold no clinical data, so these views rename columns and plant staging
phrases.  Every SQL text below runs unchanged in Spark SQL and in DuckDB (no lambdas, no
engine-specific functions), so the Spark queries and the DuckDB oracle see the same
inputs (Spark joins one view by an equivalent condition, ``SPARK_SQL``).  No view drops
rows to make a check cheaper: the cohort is chosen by customer attributes, metadata covers
every lineitem row, every document becomes a note.

    patient_ids      cohort ids: two market segments, some ids twice, some unknown ids
    patdurabledim    id -> durable key, spread over four "files"; some ids repeated in a
                     later file (first file wins, then the last row of that file)
    encounterfact    one encounter per order, the ten reference columns; urgent orders twice
    note_metadata    one note per lineitem; null note keys on line 7, keys of blank notes on
                     line 6, another patient than the encounter's on some; six note types
    note_text        one note per document (its whole text and a planted phrase), a second
                     text row under the key of German documents, blank notes with keys of
                     their own
    note_text_files  note_text plus a copy of every fifth note in another file
    llm_responses    canned model responses, one per event
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.sizing import spread_coarse

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FIXTURE_SQL: dict[str, str] = {
    "patient_ids": """
select cast(c_custkey as string) as person_source_value from customer where c_mktsegment in ('BUILDING', 'MACHINERY')
union all select cast(c_custkey as string) from customer where c_mktsegment = 'BUILDING' and c_acctbal > 9000
union all select cast(c_custkey + 1000000 as string) from customer where c_acctbal < 0
""",
    "patdurabledim": """
select cast(c_custkey as string) as patientepicid, c_name as patientdurablekey, c_nationkey % 4 as file_no, c_custkey as row_no from customer
union all select cast(c_custkey as string), concat(c_name, '-dup'), 3, c_custkey + 1000000 from customer where c_acctbal > 9000
""",
    "encounterfact": """
select patientdurablekey, encounterkey,
 cast(year(d0) * 10000 + month(d0) * 100 + day(d0) as bigint) as datekey, d0 as datekeyvalue,
 cast(year(d1) * 10000 + month(d1) * 100 + day(d1) as bigint) as enddatekey, d1 as enddatekeyvalue,
 cast(year(a0) * 10000 + month(a0) * 100 + day(a0) as bigint) as admissiondatekey, a0 as admissiondatekeyvalue,
 cast(year(a1) * 10000 + month(a1) * 100 + day(a1) as bigint) as dischargedatekey, a1 as dischargedatekeyvalue
from (select concat('Customer#', lpad(cast(o_custkey as string), 9, '0')) as patientdurablekey,
 cast(o_orderkey as string) as encounterkey, o_orderdate as d0, o_orderdate + interval '2' day as d1,
 case when o_orderstatus = 'F' then o_orderdate end as a0,
 case when o_orderstatus = 'F' then o_orderdate + interval '2' day end as a1 from orders
 union all select concat('Customer#', lpad(cast(o_custkey as string), 9, '0')), cast(o_orderkey as string),
 o_orderdate, o_orderdate + interval '4' day, null, null from orders where o_orderpriority = '1-URGENT') o
""",
    "note_metadata": """
select concat('Customer#', lpad(cast(case when o_orderpriority = '5-LOW' and l_linenumber = 1 then o_custkey + 1
  else o_custkey end as string), 9, '0')) as patientdurablekey,
 cast(o_custkey as string) as patientepicid, cast(l_orderkey as string) as encounterkey,
 case l_linenumber when 7 then null when 6 then concat('B', cast(l_partkey as string)) else cast(l_partkey as string) end as deid_note_key,
 concat('D', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as deid_note_id,
 case concat(l_returnflag, l_linestatus) when 'AF' then 'Progress Notes' when 'AO' then 'Imaging'
  when 'NF' then 'H&P' when 'NO' then 'Discharge Summary' when 'RF' then 'Telephone Encounter'
  else 'Patient Instructions' end as note_type
from lineitem join orders on o_orderkey = l_orderkey
""",
    "note_text": """
select cast(doc_id as string) as deid_note_key, doc_id as note_no, doc_id % 7 as file_no,
 concat(text, chr(10), case doc_id % 8
  when 0 then 'Impression: stage IIB carcinoma of the breast, pathology T2N1M0.'
  when 1 then 'Plan: cT3N2M0 adenocarcinoma, AJCC Stage III, options discussed.'
  when 2 then 'Summary: T1, N0, M0 on imaging, no spread seen'
  when 3 then 'Stage: iiia per tumor board'
  when 4 then 'Lesion of type IV, staging ordered, type II then stage pending'
  when 5 then 'Stage 0a in situ, then stage II on review'
  when 6 then 'The XIX century hall has a stage, V century, II c x staging'
  else 'No findings.' end) as note_text
from documents
union all select cast(doc_id as string), doc_id + 2000000000, (doc_id + 3) % 7, concat('Addendum: Stage IVA confirmed.', chr(10), text)
from documents where lang = 'de'
union all select concat('B', cast(doc_id as string)), doc_id + 1000000000, doc_id % 7, case doc_id % 3 when 0 then ' ' when 1 then '' end
from documents where lang = 'es'
""",
    "note_text_files": """
select deid_note_key, note_no, file_no, note_text from note_text
union all select deid_note_key, note_no, (file_no + 3) % 7, note_text || ' (copy)' from note_text where note_no % 5 = 0
""",
    "llm_responses": """
select event_id, case event_id % 10 when 0 then 'NA' when 1 then 'Stage: IIB' when 2 then 'TNM: T2N1M0'
 when 3 then concat('TNM: T3N2M1', chr(10)) when 4 then concat('Stage: IV', chr(10), 'and a second line')
 when 5 then 'T3N2M1' when 6 then 'The chart gives TNM: T2N0M0'
 when 7 then 'On review this is Stage: IIIA' when 8 then 'see (x) T1N0M0).' else 'TNM:' end as response
from events
""",
}
# The same rows as Spark builds them: metadata meet their orders by the text of the order key, which
# is the encounter key that they are joined by next, so that they are shuffled once for both.
SPARK_SQL = FIXTURE_SQL | {"note_metadata": FIXTURE_SQL["note_metadata"].replace(
    "on o_orderkey = l_orderkey", "on cast(o_orderkey as string) = cast(l_orderkey as string)")}
# Each small test file holds a single row group, which Spark reads in one task.  The tables behind
# the metadata, encounter and text views are spread after the scan when a number is given and
# their row groups are too few to keep that many tasks busy.
SPREAD_TABLES = ("lineitem", "orders", "documents")
# Views a fixture depends on (other fixtures), in creation order.
FIXTURE_ORDER = ("patient_ids", "patdurabledim", "encounterfact", "note_metadata", "note_text",
                 "note_text_files", "llm_responses")
FIXTURE_DEPS = {"note_text_files": ("note_text",)}


class Fixtures:
    """Registers the base tables of ``sf_dir`` and the fixture views in a session."""

    _registered: dict[int, str] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        key = id(spark)
        if Fixtures._registered.get(key) == self.sf_dir and all(
                spark.catalog.tableExists(n) for n in FIXTURE_ORDER):
            return
        for t in BASE_TABLES:
            df = spark.read.parquet(f"{self.sf_dir}/{t}.parquet")
            if t in SPREAD_TABLES:
                df = spread_coarse(df, partitions)
            df.createOrReplaceTempView(t)
        for name in FIXTURE_ORDER:
            spark.sql(SPARK_SQL[name]).createOrReplaceTempView(name)
        Fixtures._registered[key] = self.sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in FIXTURE_SQL or name in BASE_TABLES:
            return self.spark.table(name)
        raise AttributeError(name)


def with_fixture_ctes(sql: str, names: tuple[str, ...] | None = None) -> str:
    """Prefix an oracle query with the fixture views it needs as CTEs (DuckDB side)."""
    wanted = list(names) if names is not None else [n for n in FIXTURE_ORDER if n in sql]
    order: list[str] = []
    for n in FIXTURE_ORDER:
        if n in wanted or any(n in FIXTURE_DEPS.get(w, ()) for w in wanted):
            order.append(n)
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n].strip()})" for n in order)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
