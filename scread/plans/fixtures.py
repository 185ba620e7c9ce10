"""Reads, barcodes, counts and alignments derived from the given tables by SQL that Spark and DuckDB share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def _t(x: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','ACGTACGTACGTACGT')"


def _s(k: str) -> str:
    return f"cast({k} as varchar(9))"


def _mut(s: str, p: int) -> str:
    return f"concat(substr({s},1,{p - 1}),translate(substr({s},{p},1),'ACGT','CGTA'),substr({s},{p + 1}))"


def _nmask(s: str, p: int) -> str:
    return f"concat(substr({s},1,{p - 1}),'N',substr({s},{p + 1}))"


def _rc(s: str) -> str:
    return f"reverse(translate({s},'ACGT','TGCA'))"


def _tag(prefix: str, k: str) -> str:
    return _t(f"concat('{prefix}-',{_s(k)})")


BARCODES = f"""
SELECT 'p5' AS type, concat(substr('ABCDEFGH',cast(p_partkey+1 as int),1),'01') AS barcode, substr({_tag('p5', 'p_partkey')},1,10) AS sequence FROM part WHERE p_partkey<8
UNION ALL SELECT 'p7', concat('A',lpad({_s('p_partkey+1')},2,'0')), substr({_tag('p7', 'p_partkey')},1,10) FROM part WHERE p_partkey<12
UNION ALL SELECT 'rt', concat('P01-',substr('ABCDEFGH',cast(floor(p_partkey/12) as int)+1,1),lpad({_s('p_partkey%12+1')},2,'0')), substr({_tag('rt', 'p_partkey')},1,10) FROM part WHERE p_partkey<96
UNION ALL SELECT 'ligation', concat('LIG',{_s('p_partkey')}), substr({_tag('lig', 'p_partkey')},1,CASE WHEN p_partkey<48 THEN 10 ELSE 9 END) FROM part WHERE p_partkey<96
"""

READS = f"""
SELECT event_id AS pair_id, concat('read',{_s('event_id')}) AS name, concat('1:N:0:',p7,'+',{_rc('p5')}) AS comment,
  concat(lig,'CAGAGC',umi,rt,CASE WHEN kl<48 THEN '' ELSE 'T' END) AS r1_seq, r2 AS r2_seq
FROM (SELECT event_id, kl, umi, r2,
    CASE WHEN m=0 THEN {_mut('p5', 3)} ELSE p5 END AS p5,
    CASE WHEN m=1 THEN {_mut(_mut('p7', 2), 7)} ELSE p7 END AS p7,
    CASE WHEN m=2 THEN {_mut('rt', 4)} WHEN m=4 THEN {_nmask('rt', 5)} ELSE rt END AS rt,
    CASE WHEN m=3 THEN {_mut('lig', 6)} ELSE lig END AS lig
  FROM (SELECT event_id, m, kl, substr({_tag('p5', 'k5')},1,10) AS p5, substr({_tag('p7', 'k7')},1,10) AS p7, substr({_tag('rt', 'kr')},1,10) AS rt,
      substr({_tag('lig', 'kl')},1,CASE WHEN kl<48 THEN 10 ELSE 9 END) AS lig, substr({_tag('umi', 'event_id')},1,8) AS umi,
      concat({_tag('a', 'event_id')},{_tag('b', 'event_id')}) AS r2
    FROM (SELECT event_id, event_id%10 AS m, event_id%8 AS k5, event_id%12 AS k7, (event_id*7)%96 AS kr, (event_id*13)%96 AS kl FROM events) k) s) e
"""

SAMPLES = """
SELECT 'S_A' AS sample, 'A01:D01' AS p5, 'A01:A06' AS p7, 'P01-A01:P01-H12' AS rt
UNION ALL SELECT 'S_B', 'E01:H01', 'A07:A12', 'P01-A01:P01-H12'
"""

COUNTS = """
SELECT l_returnflag AS dataset, l_suppkey AS cell, l_partkey AS gene, cast(sum(l_quantity) as bigint) AS umis
FROM lineitem GROUP BY l_returnflag, l_suppkey, l_partkey
"""

_CONTIG = "CASE {0}%5 WHEN 0 THEN 'chr1' WHEN 1 THEN 'chr2' WHEN 2 THEN 'chr3' WHEN 3 THEN 'chrM' ELSE 'MT' END"

ALIGNMENTS = f"""
SELECT event_id AS pair_id, CASE event_type WHEN 'error' THEN 4 WHEN 'signup' THEN 256 WHEN 'click' THEN 16 ELSE 0 END AS flag,
  {_CONTIG.format('user_id')} AS contig, cast(floor(value*100) as int)+1 AS pos, cast(floor(value*100) as int)+91 AS end_pos,
  CASE WHEN event_type='signup' THEN cast(2+event_id%11 as int) WHEN event_id%6=0 THEN 3 ELSE 1 END AS nh,
  cast(20+event_id%80 as int) AS as_score, cast(user_id as varchar(9)) AS cb FROM events
"""

FEATURES = f"""
SELECT p_partkey AS gene, {_CONTIG.format('p_partkey')} AS contig, cast(p_partkey*25+1 as int) AS f_start,
  cast(p_partkey*25+1+p_size*20 as int) AS f_end, CASE WHEN p_partkey%2=0 THEN '+' ELSE '-' END AS strand,
  CASE WHEN p_brand='Brand#2' THEN 'rRNA' ELSE 'exon' END AS ftype FROM part
"""

# reads before counting: a UMI of 3 letters over few values, so that neighbours and shared UMIs occur
MOLECULES = f"""
SELECT cast(l_suppkey as varchar(9)) AS cell, cast(l_partkey%40 as varchar(9)) AS gene, substr({_tag('m', 'l_orderkey%97')},1,4) AS umi, count(*) AS n_reads
FROM lineitem GROUP BY 1, 2, 3
"""

# one run of another tool per nation, with a number and a share to report
RUNS = """
SELECT concat('N',cast(n_nationkey as varchar(9))) AS sample, count(c_custkey)+1 AS n, cast((n_nationkey%20+1)/32.0 as double) AS sat
FROM nation LEFT JOIN (SELECT c_nationkey, c_custkey FROM customer) c ON c_nationkey=n_nationkey GROUP BY n_nationkey
"""

# droplets: suppliers are cells, orders are mostly empty drops with a few molecules
DROPLETS = """
SELECT l_returnflag AS dataset, CASE WHEN l_orderkey%4=0 THEN concat('S',cast(l_suppkey as varchar(9))) ELSE concat('O',cast(l_orderkey as varchar(9))) END AS cell,
  CASE WHEN l_orderkey%4=0 THEN l_suppkey%50+(l_partkey%40) ELSE l_partkey%200 END AS gene, cast(sum(l_quantity) as bigint) AS umis
FROM lineitem GROUP BY 1, 2, 3
"""

FIXTURES = {"fx_barcodes": BARCODES, "fx_reads": READS, "fx_samples": SAMPLES, "fx_counts": COUNTS, "fx_alignments": ALIGNMENTS, "fx_features": FEATURES, "fx_molecules": MOLECULES, "fx_runs": RUNS, "fx_droplets": DROPLETS}


def fixture(spark: SparkSession, sf_dir: str, name: str, dealt: Callable[[DataFrame], DataFrame] = lambda table: table) -> DataFrame:
    """The fixture of the tables it names, each ``dealt`` before the SQL's expressions are evaluated."""
    sql = FIXTURES[name]
    used = [t for t in TABLES if f" {t} " in f" {sql} ".replace("\n", " ").replace(")", " ").replace("(", " ")]
    text = sql.replace("{", "{{").replace("}", "}}")
    for t in used:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(text, **{t: dealt(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in used})


def with_fixtures(sql: str) -> str:
    """The SQL with the fixtures it names in front."""
    names = [n for n in FIXTURES if n in sql]
    if not names:
        return sql
    head = ", ".join(f"{n} AS ({FIXTURES[n].strip()})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"
