"""The driver's tables seen as a stage: expressions over whole tables, no samples.

Each binding exists twice, as a DataFrame here and as SQL text for the oracle,
so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ["AND", "OR", "XOR", "NOT", "TON", "TOF", "SR", "ADD", "SUB", "MUL", "MIN", "MAX", "LT", "GE", "MOVE", "CALL"]
HELD_TEMPLATES = ["src7"]
HELD_BLOCKS = ["Node.get_3"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a small table arrives as fewer partitions than there are cores.

    A table of many files has partitions enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Rows of a task where each of them becomes a whole program with its traces.
ROWS_A_TASK = 100_000


def spread_rows(df: DataFrame) -> DataFrame:
    """Tasks of a bounded number of rows, for small rows that much is made of: a file's bytes say nothing about that work.

    The rows are counted first, which reads the footers.
    """
    tasks = tasks_of(df)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def tasks_of(df: DataFrame) -> int:
    """Tasks that bound the rows of a table in each; the rows are counted, which reads the footers."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))


def keyed_rows(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows that much is made of, exchanged once by what they are grouped or joined by, while they are small.

    The number is given, so the tasks are not merged to a size that says nothing about what becomes of the rows.
    """
    return df.repartition(tasks, *keys)


# --- documents as programs -----------------------------------------------------------


def _parts(text: Column) -> Column:
    return F.filter(F.split(text, "[.\n]+"), lambda s: F.length(s) > 0)


def _kind(s: Column) -> Column:
    return F.get(F.array(*[F.lit(k) for k in KINDS]), F.length(s) % 16)


def _line(s: Column, i: Column) -> Column:
    h = F.length(s)
    previous = F.when(i == 0, "a").otherwise(F.concat(F.lit("b"), i.cast("string"), F.lit(".OUT")))
    kind = _kind(s)
    number = lambda c: c.cast("string")
    args = (
        F.when(kind.isin("NOT", "MOVE"), F.concat(F.lit("(IN="), previous, F.lit(")")))
        .when(kind.isin("TON", "TOF"), F.concat(F.lit("(IN="), previous, F.lit(", PT=T#"), number(125 * (1 + h % 8)), F.lit("ms)")))
        .when(kind == "SR", F.concat(F.lit("(S1="), previous, F.lit(", R=x)")))
        .when(kind.isin("ADD", "MUL", "MIN", "MAX"), F.concat(F.lit("(IN1="), previous, F.lit(", IN2="), number(h % 9), F.lit(".5)")))
        .when(kind.isin("SUB", "LT", "GE"), F.concat(F.lit("(IN1="), previous, F.lit(", IN2="), number(h % 5), F.lit(")")))
        .when(kind == "CALL", F.concat(F.lit("[Node.get_"), number(h % 7), F.lit("](TARGET="), previous, F.lit(")")))
        .otherwise(F.concat(F.lit("(IN1="), previous, F.lit(", IN2=b)")))
    )
    return F.concat(F.lit("b"), number(i + 1), F.lit(" = "), kind, args)


def programs(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, family, template_id, seed, frame_id, text, xml): one program per document."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))
    docs = docs.withColumn("ps", _parts(F.col("text")))
    head = F.concat(F.lit("program p"), F.col("doc_id").cast("string"), F.lit("\nin a : BOOL\nin x : REAL\nout ret : REAL\nvar hold : BOOL\n"))
    body = F.array_join(F.transform("ps", _line), "\n")
    tail = F.concat(F.lit("\nret = b"), F.size("ps").cast("string"), F.lit(".OUT\n"))
    xml = F.array_join(F.transform("ps", lambda s: F.concat(F.lit('<block typeName="'), _kind(s), F.lit('"/>'))), "")
    return docs.select(
        "doc_id",
        F.col("lang").alias("family"),
        F.col("source").alias("template_id"),
        F.col("doc_id").alias("seed"),
        (F.col("doc_id") % 3).alias("frame_id"),
        F.concat(head, body, tail).alias("text"),
        xml.alias("xml"),
    )


PROGRAMS_SQL = r"""
parts AS (
  SELECT doc_id, lang, source, list_filter(regexp_split_to_array(text, '[.\n]+'), lambda s: length(s) > 0) AS ps FROM documents
),
programs AS (
  SELECT doc_id, lang AS family, source AS template_id, doc_id AS seed, doc_id % 3 AS frame_id,
    'program p' || doc_id || chr(10) || 'in a : BOOL' || chr(10) || 'in x : REAL' || chr(10) || 'out ret : REAL' || chr(10) || 'var hold : BOOL' || chr(10)
    || array_to_string(list_transform(ps, lambda s, i:
      'b' || i || ' = ' || ks[length(s) % 16 + 1] || CASE
        WHEN ks[length(s) % 16 + 1] IN ('NOT', 'MOVE') THEN '(IN=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ')'
        WHEN ks[length(s) % 16 + 1] IN ('TON', 'TOF') THEN '(IN=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ', PT=T#' || (125 * (1 + length(s) % 8)) || 'ms)'
        WHEN ks[length(s) % 16 + 1] = 'SR' THEN '(S1=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ', R=x)'
        WHEN ks[length(s) % 16 + 1] IN ('ADD', 'MUL', 'MIN', 'MAX') THEN '(IN1=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ', IN2=' || (length(s) % 9) || '.5)'
        WHEN ks[length(s) % 16 + 1] IN ('SUB', 'LT', 'GE') THEN '(IN1=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ', IN2=' || (length(s) % 5) || ')'
        WHEN ks[length(s) % 16 + 1] = 'CALL' THEN '[Node.get_' || (length(s) % 7) || '](TARGET=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ')'
        ELSE '(IN1=' || CASE WHEN i = 1 THEN 'a' ELSE 'b' || (i - 1) || '.OUT' END || ', IN2=b)' END), chr(10))
    || chr(10) || 'ret = b' || len(ps) || '.OUT' || chr(10) AS text,
    array_to_string(list_transform(ps, lambda s: '<block typeName="' || ks[length(s) % 16 + 1] || '"/>'), '') AS xml
  FROM parts, (SELECT ['AND','OR','XOR','NOT','TON','TOF','SR','ADD','SUB','MUL','MIN','MAX','LT','GE','MOVE','CALL'] AS ks)
)
"""


def document_stage(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(root, candidates) of the documents' programs.

    Every fourth program is stored as XML only. Every 61st row has no rank1.
    """
    p = programs(spark, sf)
    key = F.concat_ws("/", "family", "template_id", F.col("seed").cast("string"))
    root = p.select(key.alias("key"), "family", "template_id", "seed", "frame_id")
    as_xml = F.col("seed") % 4 == 0
    entries = [
        F.struct(F.lit(name).alias("candidate"), F.lit(rank).alias("rank"))
        for name, rank in (("rank1", 1), ("rank3", 3), ("rank5", 5))
    ]
    candidates = (
        p.select(
            key.alias("row_key"),
            "seed",
            F.when(as_xml, "").otherwise(F.col("text")).alias("fbd_text"),
            F.when(as_xml, F.col("xml")).otherwise("").alias("fbd_xml"),
            F.inline(F.array(*entries)),
        )
        .filter(~((F.col("candidate") == "rank1") & (F.col("seed") % 61 == 60)))
        .drop("seed")
    )
    return root, candidates


STAGE_SQL = PROGRAMS_SQL + r""",
kinds AS (
  SELECT family || '/' || template_id || '/' || seed AS key, family, template_id, seed, frame_id, seed % 61 = 60 AS missing,
    CASE WHEN seed % 61 = 60 THEN []
    ELSE list_filter(regexp_extract_all(src, '(?m)^\w+ = ([A-Z_]+)[\[(]', 1), lambda k: k <> 'CALL')
      || regexp_extract_all(src, 'CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]', 1) END AS blocks
  FROM (SELECT *, CASE WHEN seed % 4 <> 0 THEN text ELSE regexp_replace(xml, 'typeName="([A-Z_]+)"', chr(10) || '_ = \1(', 'g') END AS src FROM programs)
),
rows AS (
  SELECT *, CASE WHEN template_id = 'src7' OR list_contains(blocks, 'Node.get_3') THEN 'evaluation'
    WHEN seed % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM kinds
)
"""


# --- orders as intents -----------------------------------------------------------------

ORDER_KINDS = {"1": "AND", "2": "OR", "3": "TON", "4": "MOD", "5": "SEL"}


def order_rows(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """In-flight rows: one intent per order with its three programs."""
    o = orders if orders is not None else table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    kind = F.get(F.array(*[F.lit(k) for k in ORDER_KINDS.values()]), F.substring("o_orderpriority", 1, 1).cast("int") - 1)

    def program(k: Column | str, tail: str = "") -> Column:
        k = k if isinstance(k, Column) else F.lit(k)
        return F.concat(
            F.lit("program o"), key, F.lit("\nb1 = "), k, F.lit("(IN1=a, IN2="), F.col("o_custkey").cast("string"),
            F.lit(")\nret = b1.OUT\n" + tail),
        )

    return o.select(
        F.lit("fbd").alias("family"),
        F.col("o_orderpriority").alias("template_id"),
        F.col("o_orderkey").alias("seed"),
        F.concat(F.lit("handle order "), key).alias("intent"),
        (F.col("o_orderkey") % 3).alias("frame_id"),
        F.array(kind, F.concat(F.lit("STATUS_"), "o_orderstatus"), kind).alias("blocks"),
        program(kind).alias("rank1"),
        program("NOT").alias("rank3"),
        program(kind, "stray\n").alias("rank5"),
    )


def order_scores(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """Score relation of the orders, with one broken control of each sort planted."""
    o = orders if orders is not None else table(spark, sf, "orders")
    seed = F.col("o_orderkey")

    def score(name: str, compiles: Column, runs: Column, effect: Column) -> Column:
        return F.struct(
            F.lit(name).alias("candidate"), compiles.alias("parses"), compiles.alias("compiles"), runs.alias("runs"),
            effect.alias("effect_matches"), (seed % 7).alias("steps"), (seed % 90).alias("wall_ms"),
            F.when(compiles, "").otherwise("refused: unknown pin").alias("refusal"),
        )

    yes, no = F.lit(True), F.lit(False)
    entries = [
        score("rank1", yes, yes, seed % 97 != 0),
        score("rank3", yes, yes, seed % 101 == 0),
        score("rank5", seed % 103 == 0, no, no),
    ]
    key = F.concat_ws("/", F.lit("fbd"), "o_orderpriority", seed.cast("string"))
    return o.select(key.alias("row_key"), F.inline(F.array(*entries)))


ORDERS_SQL = r"""
order_rows AS (
  SELECT 'fbd/' || o_orderpriority || '/' || o_orderkey AS key, o_orderpriority AS template_id, o_orderkey AS seed,
    'handle order ' || o_orderkey AS intent, o_orderkey % 3 AS frame_id,
    [['AND','OR','TON','MOD','SEL'][CAST(o_orderpriority[1] AS INT)], 'STATUS_' || o_orderstatus] AS blocks,
    'program o' || o_orderkey || chr(10) || 'b1 = ' AS head,
    ['AND','OR','TON','MOD','SEL'][CAST(o_orderpriority[1] AS INT)] AS kind,
    '(IN1=a, IN2=' || o_custkey || ')' || chr(10) || 'ret = b1.OUT' || chr(10) AS tail
  FROM orders
),
cands AS (
  SELECT key, template_id, seed, candidate, rank,
    head || CASE WHEN rank = 3 THEN 'NOT' ELSE kind END || tail || CASE WHEN rank = 5 THEN 'stray' || chr(10) ELSE '' END AS fbd_text
  FROM order_rows, (VALUES ('rank1', 1), ('rank3', 3), ('rank5', 5)) r(candidate, rank)
),
scores AS (
  SELECT key AS row_key, seed, candidate,
    CASE WHEN rank = 5 THEN seed % 103 = 0 ELSE true END AS compiles,
    rank <> 5 AS runs,
    CASE rank WHEN 1 THEN seed % 97 <> 0 WHEN 3 THEN seed % 101 = 0 ELSE false END AS effect_matches,
    seed % 7 AS steps, seed % 90 AS wall_ms
  FROM cands
)
"""


# --- orders as blocks of their customer's program ------------------------------------------


def program_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(program, decl, block, pin, write): a program per customer, a block per order."""
    o = table(spark, sf, "orders").withColumn("program", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    null = F.lit(None)

    def value(tag: str, text=null, pin=null, num=null) -> Column:
        return F.struct(
            F.lit(tag).alias("tag"), text.cast("string").alias("text"), pin.cast("string").alias("pin"), num.cast("double").alias("num")
        )

    customer = table(spark, sf, "customer").withColumn("program", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    program = customer.select("program")
    decl = customer.select(
        "program",
        F.inline(
            F.array(
                F.struct(F.lit("in").alias("section"), F.lit(0).alias("pos"), F.lit("x").alias("name"), F.lit("REAL").alias("type")),
                F.struct(F.lit("out").alias("section"), F.lit(0).alias("pos"), F.lit("ret").alias("name"), F.lit("REAL").alias("type")),
                F.struct(F.lit("var").alias("section"), F.lit(0).alias("pos"), F.lit("hold").alias("name"), F.lit("BOOL").alias("type")),
            )
        ),
    )
    bid = F.concat(F.lit("b"), F.col("o_orderkey").cast("string"))
    called = F.col("o_orderstatus") == "F"
    block = o.select(
        "program", F.col("o_orderkey").alias("pos"), bid.alias("id"),
        F.when(called, "CALL").when(F.col("o_orderstatus") == "O", "MUL").otherwise("SUB").alias("kind"),
        F.when(called, F.concat(F.lit("Desk.p"), F.substring("o_orderpriority", 1, 1))).alias("sig"),
    )
    pin = o.select(
        "program", bid.alias("block_id"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("pos"), F.lit("IN1").alias("name"), value("var", F.lit("x")).alias("value")),
                F.struct(F.lit(1).alias("pos"), F.lit("IN2").alias("name"), value("int", num=F.col("o_orderkey") % 50).alias("value")),
                F.struct(F.lit(2).alias("pos"), F.lit("PT").alias("name"), value("time_ms", num=F.col("o_orderkey") % 9 * 250).alias("value")),
                F.struct(F.lit(3).alias("pos"), F.lit("NOTE").alias("name"), value("string", F.col("o_orderpriority")).alias("value")),
            )
        ),
    )
    write = customer.select("program", F.lit(0).alias("pos"), F.lit("ret").alias("name"), value("ref", F.lit("b0"), F.lit("OUT")).alias("value"))
    return program, decl, block, pin, write


PROGRAM_TABLES_SQL = r"""
block AS (
  SELECT 'c' || o_custkey AS program, o_orderkey AS pos, 'b' || o_orderkey AS id,
    CASE o_orderstatus WHEN 'F' THEN 'CALL' WHEN 'O' THEN 'MUL' ELSE 'SUB' END AS kind,
    CASE WHEN o_orderstatus = 'F' THEN 'Desk.p' || o_orderpriority[1] END AS sig
  FROM orders
),
pin AS (
  SELECT 'c' || o_custkey AS program, 'b' || o_orderkey AS block_id, p.pos, p.name, CASE p.pos
      WHEN 0 THEN 'x' WHEN 1 THEN CAST(o_orderkey % 50 AS VARCHAR)
      WHEN 2 THEN CASE WHEN o_orderkey % 9 * 250 % 1000 = 0 THEN 'T#' || (o_orderkey % 9 * 250 // 1000) || 's' ELSE 'T#' || (o_orderkey % 9 * 250) || 'ms' END
      ELSE '"' || o_orderpriority || '"' END AS val
  FROM orders, (VALUES (0, 'IN1'), (1, 'IN2'), (2, 'PT'), (3, 'NOTE')) p(pos, name)
)
"""


# --- events as traces -----------------------------------------------------------------------


def trace_events(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, hour, ts, event_id, lx, ly, btn, tracker_ok): a trace per user, in time order, not yet numbered."""
    e = table(spark, sf, "events").select("user_id", F.date_trunc("hour", "ts").alias("hour"), "ts", "event_id", "event_type")
    return e.select(
        "user_id", "hour", "ts", "event_id",
        ((F.col("event_id") % 201 - 100) / F.lit(100.0)).alias("lx"),
        ((F.col("event_id") * 7 % 201 - 100) / F.lit(100.0)).alias("ly"),
        (F.col("event_type") == "click").alias("btn"),
        (F.col("event_type") != "error").alias("tracker_ok"),
    )


def trace_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """``trace_events`` with their tick."""
    from labelmill.operators import ranking

    return ranking.scan(trace_events(spark, sf), ["user_id"], ["ts", "event_id"], "hour", position="tick")


TRACE_SQL = r"""
ticks AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS tick, event_id,
    (event_id % 201 - 100) / 100.0::DOUBLE AS lx, (event_id * 7 % 201 - 100) / 100.0::DOUBLE AS ly,
    event_type = 'click' AS btn, event_type <> 'error' AS tracker_ok
  FROM events
)
"""


# --- line items as archive entries --------------------------------------------------------------


def entries(spark: SparkSession, sf: str) -> DataFrame:
    """(archive, subject, name, bytes) with every sort of refused name and bytes planted."""
    li = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    n = F.col("l_partkey")
    text = lambda c: c.cast("string")
    subject = F.col("l_suppkey")
    sub = F.when(n % 89 == 0, subject + 1).otherwise(subject)
    trial = F.col("l_linenumber") % 2 + 1
    dir_trial = F.when(n % 83 == 0, trial + 1).otherwise(trial)
    stream = n % 3 + 1
    shown = F.when(n % 79 == 0, n % 3 + 2).otherwise(stream)
    sort = F.col("l_orderkey") % 3
    pos, command = F.col("l_linenumber"), F.col("l_orderkey") % 1000
    third = F.when(n % 73 == 0, F.lit("3")).otherwise(F.when(sort == 0, "1").otherwise("2"))
    still_dir = F.get(F.array(F.lit("thr_image"), F.lit("rgb_image"), F.lit("rgb_image_aligned")), (stream - 1).cast("int"))
    cmd_dir = F.get(F.array(F.lit("thr_image_cmd"), F.lit("rgb_image_cmd"), F.lit("rgb_image_cmd_aligned")), (stream - 1).cast("int"))
    directory = F.when(sort == 0, still_dir).when(sort == 1, cmd_dir).otherwise("mic1_audio_cmd_trim")
    frame = F.when(n % 71 == 0, F.lit("x")).otherwise(text(F.col("l_orderkey")))
    file = (
        F.when(sort == 0, F.concat(F.concat_ws("_", text(sub), text(trial), third, text(pos), frame, text(shown)), F.lit(".png")))
        .when(sort == 1, F.concat(F.concat_ws("_", text(sub), text(trial), third, text(pos), text(command), frame, text(shown)), F.lit(".png")))
        .otherwise(F.concat(F.concat_ws("_", text(sub), text(trial), third, text(pos), text(command), frame), F.lit(".wav")))
    )
    root = F.when(sort == 0, F.concat(F.lit("sub_"), text(subject), F.lit("_io"))).otherwise(F.concat(F.lit("sub_"), text(subject), F.lit("_ia")))
    name = F.when(n % 67 == 0, F.concat_ws("/", root, file)).otherwise(
        F.concat_ws("/", root, F.concat(F.lit("trial_"), text(dir_trial)), directory, file)
    )
    magic = F.when(n % 61 == 0, F.unhex(F.lit("FFD8FF"))).when(sort == 2, F.unhex(F.lit("52494646"))).otherwise(F.unhex(F.lit("89504E470D0A1A0A")))
    return li.select(
        F.concat(root, F.lit(".zip")).alias("archive"), subject.alias("subject"), name.alias("name"),
        F.concat(magic, F.encode(name, "UTF-8")).alias("bytes"),
    )


ENTRIES_SQL = r"""
raw_entries AS (
  SELECT l_suppkey AS subject, l_orderkey % 3 AS sort, l_partkey AS n, l_linenumber % 2 + 1 AS trial, l_partkey % 3 + 1 AS stream, l_linenumber AS pos,
    l_orderkey % 1000 AS command, CASE WHEN l_partkey % 71 = 0 THEN 'x' ELSE CAST(l_orderkey AS VARCHAR) END AS frame,
    CASE WHEN l_partkey % 89 = 0 THEN l_suppkey + 1 ELSE l_suppkey END AS sub,
    CASE WHEN l_partkey % 83 = 0 THEN l_linenumber % 2 + 2 ELSE l_linenumber % 2 + 1 END AS dir_trial,
    CASE WHEN l_partkey % 79 = 0 THEN l_partkey % 3 + 2 ELSE l_partkey % 3 + 1 END AS shown,
    CASE WHEN l_partkey % 73 = 0 THEN '3' WHEN l_orderkey % 3 = 0 THEN '1' ELSE '2' END AS third
  FROM lineitem
),
named_entries AS (
  SELECT *, 'sub_' || subject || CASE WHEN sort = 0 THEN '_io' ELSE '_ia' END AS root,
    CASE sort WHEN 0 THEN ['thr_image', 'rgb_image', 'rgb_image_aligned'][stream] WHEN 1 THEN ['thr_image_cmd', 'rgb_image_cmd', 'rgb_image_cmd_aligned'][stream]
      ELSE 'mic1_audio_cmd_trim' END AS directory,
    CASE sort WHEN 0 THEN concat_ws('_', sub, trial, third, pos, frame, shown) || '.png'
      WHEN 1 THEN concat_ws('_', sub, trial, third, pos, command, frame, shown) || '.png'
      ELSE concat_ws('_', sub, trial, third, pos, command, frame) || '.wav' END AS file
  FROM raw_entries
),
entries AS (
  SELECT *, root || '.zip' AS archive,
    CASE WHEN n % 67 = 0 THEN root || '/' || file ELSE root || '/trial_' || dir_trial || '/' || directory || '/' || file END AS name,
    CASE WHEN n % 67 = 0 THEN 'unrecognised_path' WHEN n % 71 = 0 THEN 'not_an_integer' WHEN n % 73 = 0 THEN 'unrecognised_fields'
      WHEN n % 79 = 0 AND sort < 2 THEN 'stream_dir_disagrees' WHEN n % 83 = 0 THEN 'trial_dir_disagrees' END AS reason,
    CASE sort WHEN 0 THEN 'still' WHEN 1 THEN 'cmd' ELSE 'utterance' END AS kind
  FROM named_entries
),
keyed AS (
  SELECT *, CASE WHEN n % 61 = 0 THEN 3 WHEN sort = 2 THEN 4 ELSE 8 END + length(name) AS size FROM entries
)
"""


# --- documents as a published dataset -------------------------------------------------------------


def asset_values(spark: SparkSession, sf: str) -> DataFrame:
    """(repo, tbl, col, pos, value): three text columns of each language's table of each source's dataset, one of them the documents' texts."""
    d = table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")
    rows_path = F.concat(F.lit("rows/"), "source", F.lit("/"), key, F.lit("/rank1.fbd"))
    first = (
        F.when(F.col("doc_id") % 3 == 0, rows_path)
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("./assets/"), key, F.when(F.col("doc_id") % 9 == 7, ".PNG ").otherwise(".PNG")))
        .otherwise("program p")
    )
    picture = F.when(F.col("lang") == "en", F.concat(F.lit("assets/shared-"), "source", F.lit(".jpg"))).otherwise("none")
    entries = F.array(
        *[F.struct(F.lit(name).alias("col"), value.alias("value")) for name, value in (("fbd_path", first), ("note", F.col("text")), ("picture", picture))]
    )
    return d.select(
        F.concat(F.lit("owner/"), "source").alias("repo"), F.concat("lang", F.lit(".parquet")).alias("tbl"), F.col("doc_id").alias("pos"), F.inline(entries)
    )


def dataset_files(spark: SparkSession, sf: str) -> DataFrame:
    """(repo, path): assets of two documents in three, the shared picture, tables except for four sources."""
    d = table(spark, sf, "documents")
    repo = F.concat(F.lit("owner/"), "source").alias("repo")
    tabled = ~F.col("source").isin("src1", "src2", "src3", "src4")
    assets = d.filter(F.col("doc_id") % 9 != 4).select(repo, F.concat(F.lit("assets/"), F.col("doc_id").cast("string"), F.lit(".PNG")).alias("path"))
    shared = d.select(repo, F.concat(F.lit("assets/shared-"), "source", F.lit(".jpg")).alias("path")).distinct()
    tables = d.filter(tabled).select(repo, F.concat("lang", F.lit(".parquet")).alias("path")).distinct()
    return assets.unionByName(shared).unionByName(tables)


ASSETS_SQL = r"""
asset_values AS (
  SELECT 'owner/' || source AS repo, lang || '.parquet' AS tbl, 'fbd_path' AS col, doc_id AS pos,
    CASE doc_id % 3 WHEN 0 THEN 'rows/' || source || '/' || doc_id || '/rank1.fbd' WHEN 1 THEN './assets/' || doc_id || CASE WHEN doc_id % 9 = 7 THEN '.PNG ' ELSE '.PNG' END ELSE 'program p' END AS value
  FROM documents
  UNION ALL
  SELECT 'owner/' || source, lang || '.parquet', 'note', doc_id, text FROM documents
  UNION ALL
  SELECT 'owner/' || source, lang || '.parquet', 'picture', doc_id, CASE WHEN lang = 'en' THEN 'assets/shared-' || source || '.jpg' ELSE 'none' END FROM documents
),
files AS (
  SELECT 'owner/' || source AS repo, 'assets/' || doc_id || '.PNG' AS path FROM documents WHERE doc_id % 9 <> 4
  UNION ALL SELECT DISTINCT 'owner/' || source, 'assets/shared-' || source || '.jpg' FROM documents
  UNION ALL SELECT DISTINCT 'owner/' || source, lang || '.parquet' FROM documents WHERE source NOT IN ('src1', 'src2', 'src3', 'src4')
),
paths AS (
  SELECT * , regexp_replace(value, '^(\./)+', '') AS path FROM asset_values
  WHERE trim(value, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AND NOT regexp_matches(trim(value, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\n ]') AND contains(trim(value, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '.')
    AND lower(split_part(trim(value, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '.', -1)) IN ('fbd','xml','json','png','jpg','jpeg','gif','webp','glb','usda','usdc','usdz','npy','npz','ply','obj','stl',
      'wav','mp3','flac','mkv','mov','mp4','lot','svg','parquet','safetensors','gguf','onnx')
)
"""


def staged_texts(spark: SparkSession, sf: str) -> DataFrame:
    """(path, text): a staged file per document, local paths planted at the end of some and inside others."""
    d = table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")
    extension = F.get(F.array(F.lit(".json"), F.lit(".md"), F.lit(".txt"), F.lit(".bin")), (F.col("doc_id") % 4).cast("int"))
    folder = F.when(F.col("doc_id") % 17 == 0, "rows").when(F.col("doc_id") % 29 == 0, "x/home/y").otherwise(F.col("source"))
    planted = (
        F.when(F.col("doc_id") % 11 == 2, F.concat("text", F.lit("\nsee C:\\Users\\someone\\x.exe\nand /mnt/c/y")))
        .when(F.col("doc_id") % 11 == 5, F.concat(F.lit("at Camera3D:/root/x\n/HOME/me\n"), "text"))
        .when(F.col("doc_id") % 11 == 7, F.concat(F.lit("Camera3D:/root/only\n"), "text"))
        .otherwise(F.col("text"))
    )
    return d.select(F.concat(folder, F.lit("/"), key, extension).alias("path"), planted.alias("text"))


STAGED_SQL = r"""
staged AS (
  SELECT CASE WHEN doc_id % 17 = 0 THEN 'rows' WHEN doc_id % 29 = 0 THEN 'x/home/y' ELSE source END || '/' || doc_id || ['.json', '.md', '.txt', '.bin'][doc_id % 4 + 1] AS path,
    CASE doc_id % 11 WHEN 2 THEN text || chr(10) || 'see C:\Users\someone\x.exe' || chr(10) || 'and /mnt/c/y'
      WHEN 5 THEN 'at Camera3D:/root/x' || chr(10) || '/HOME/me' || chr(10) || text
      WHEN 7 THEN 'Camera3D:/root/only' || chr(10) || text ELSE text END AS text
  FROM documents
),
lines AS (
  SELECT path, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS value FROM (SELECT path, string_split(text, chr(10)) AS ls FROM staged)
)
"""
