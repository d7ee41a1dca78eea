"""Source and sink queries: a table is written below the shared folder in one format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators.ordered import collect_lists
from rivulet.session import fresh_path
from rivulet.sources import readers, sinks
from workload import adapters as a
from workload.registry import query

EVENT = "event_id long, user_id long, event_type string, value double"
EVENT_SQL = "SELECT event_id, user_id, event_type, value FROM events"


def event_columns(spark, sf):
    return a.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


@query("scan_json_records", EVENT_SQL)
def scan_json_records(spark, sf):
    path = sinks.write_json(event_columns(spark, sf), fresh_path(spark, "records"))
    return readers.json_records(spark, path, EVENT)


@query("scan_json_document", EVENT_SQL)
def scan_json_document(spark, sf):
    path = sinks.write_json_document(event_columns(spark, sf), fresh_path(spark, "documents"))
    return readers.json_document(spark, path, EVENT)


@query(
    "scan_filtered_lines",
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at, event_type AS text FROM events WHERE event_type <> 'error'",
)
def scan_filtered_lines(spark, sf):
    """A dump of posts in which errors stand for notices without ``created_at``."""
    events = a.table(spark, sf, "events")
    post = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"), F.col("event_type").alias("text"))
    notice = F.struct(F.struct("event_id").alias("delete"))
    lines = events.select(F.when(F.col("event_type") == "error", F.to_json(notice)).otherwise(F.to_json(post)).alias("line"))
    path = sinks.write_text(lines, fresh_path(spark, "dump"))
    return readers.marked_lines(spark, path, "created_at", "created_at string, text string")


BROKEN = """event_id % 7 = 0 AND event_type <> 'error'"""


@query(
    "scan_rejected_lines",
    f"""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' ELSE 'a field does not fit its type' END AS reason
    FROM events WHERE {BROKEN}""",
)
def scan_rejected_lines(spark, sf):
    """The broken ones among a dump's marked lines: cut off, wrapped in a list, or with a text for a number."""
    events = a.table(spark, sf, "events")
    post = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd").alias("created_at")))
    unfit = F.to_json(F.struct(F.concat(F.lit("no "), "event_id").alias("event_id"), F.lit("x").alias("created_at")))
    broken = F.when(F.col("event_id") % 3 == 0, F.substr(post, F.lit(1), F.length(post) - 1)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), post, F.lit("]")))
    line = F.when(F.col("event_type") == "error", F.lit('{"delete": 1}')).when(F.expr(BROKEN), F.coalesce(broken, unfit)).otherwise(post)
    path = sinks.write_text(events.select(line), fresh_path(spark, "broken"))
    rejects = readers.checked_records(spark, path, "event_id long, created_at string", "created_at").rejects
    return rejects.select(F.regexp_extract("text", "[0-9]+", 0).cast("long").alias("event_id"), "reason")


@query(
    "rowset_rejects",
    """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 2 THEN NULL ELSE 'BALANCE' END AS field, CASE s_suppkey % 4 WHEN 2 THEN 'not JSON'
    ELSE 'a field does not fit its type' END AS reason FROM supplier WHERE s_suppkey % 4 IN (1, 2)""",
)
def rowset_rejects(spark, sf):
    """Payloads of one row each; some cut off, some with a text for a number."""
    supplier = a.table(spark, sf, "supplier")
    balance = F.when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("about "), F.col("s_acctbal").cast("string"))).otherwise(F.col("s_acctbal").cast("string"))
    result = F.struct(F.array(F.lit("NAME"), F.lit("BALANCE")).alias("headers"), F.array(F.array(F.col("s_name"), balance)).alias("rowSet"))
    whole = F.to_json(F.struct(F.array(result).alias("resultSets")))
    payload = F.when(F.col("s_suppkey") % 4 == 2, F.substr(whole, F.lit(1), F.length(whole) - 3)).otherwise(whole)
    payloads = supplier.select(F.col("s_suppkey").alias("id"), payload.alias("payload"))
    return readers.rowset_rejects(payloads, {"NAME": "string", "BALANCE": "double"}, keep=["id"]).select("id", "field", "reason")


@query(
    "rowset_to_table",
    "SELECT l_suppkey AS player_id, l_orderkey AS game_id, l_quantity AS dribbles, l_discount AS close_def_dist FROM lineitem",
)
def rowset_to_table(spark, sf):
    fields = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_partkey", "l_extendedprice"]
    lines = a.table(spark, sf, "lineitem").select("l_suppkey", *fields)
    lists = collect_lists(lines, "l_suppkey", fields)
    cells = F.transform("items", lambda i: F.array(*[i[f].cast("string") for f in fields]))
    result = F.struct(F.array(*[F.lit(f.upper()) for f in fields]).alias("headers"), cells.alias("rowSet"))
    document = F.struct(F.col("l_suppkey").alias("player_id"), F.to_json(F.struct(F.array(result).alias("resultSets"))).alias("payload"))
    path = sinks.write_text(lists.select(F.to_json(document)), fresh_path(spark, "payloads"))
    payloads = readers.json_records(spark, path, "player_id long, payload string")
    table = readers.rowset_table(
        payloads, {"L_ORDERKEY": "long", "L_QUANTITY": "double", "L_DISCOUNT": "double"}, keep=["player_id"]
    )
    return table.toDF("player_id", "game_id", "dribbles", "close_def_dist")


CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("scan_csv", "SELECT * FROM customer")
def scan_csv(spark, sf):
    path = sinks.write_csv(a.table(spark, sf, "customer"), fresh_path(spark, "customer"))
    return readers.csv_table(spark, path, CUSTOMER)


@query("scan_tsv", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def scan_tsv(spark, sf):
    part = a.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    path = sinks.write_tsv(part, fresh_path(spark, "part"))
    return readers.tsv_table(spark, path, "p_partkey long, p_name string, p_type string, p_size int")


@query(
    "scan_matrix_csv",
    """SELECT CAST(o_custkey AS VARCHAR) AS row_id, count(*) FILTER (o_orderstatus = 'F')::DOUBLE AS f,
    count(*) FILTER (o_orderstatus = 'O')::DOUBLE AS o, count(*) FILTER (o_orderstatus = 'P')::DOUBLE AS p FROM orders GROUP BY 1""",
)
def scan_matrix_csv(spark, sf):
    """Customers by order status, written as a matrix with blanks around its numbers."""
    statuses = ["F", "O", "P"]
    counts = a.table(spark, sf, "orders").groupBy("o_custkey").pivot("o_orderstatus", statuses).count().na.fill(0)
    padded = counts.select("o_custkey", *[F.concat(F.lit(" "), F.col(s).cast("string")).alias(s) for s in statuses])
    path = sinks.write_csv(padded, fresh_path(spark, "matrix"))
    matrix = readers.matrix_csv(spark, path, ["o_custkey", *statuses])
    return matrix.select("row_id", *[F.get("vector", F.lit(i)).alias(s.lower()) for i, s in enumerate(statuses)])


@query(
    "view_registration",
    "SELECT user_id, count(*) AS n, max(value) AS best FROM events GROUP BY user_id",
)
def view_registration(spark, sf):
    readers.register(a.table(spark, sf, "events"), "registered_events")
    return spark.sql("SELECT user_id, count(*) AS n, max(value) AS best FROM registered_events GROUP BY user_id")


@query("sink_json", "SELECT p_partkey, p_name, p_retailprice FROM part")
def sink_json(spark, sf):
    """Written records, taken apart line by line from the files."""
    path = sinks.write_json(a.table(spark, sf, "part"), fresh_path(spark, "parts"))
    lines = spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.p_partkey").cast("long").alias("p_partkey"),
        F.get_json_object("value", "$.p_name").alias("p_name"),
        F.get_json_object("value", "$.p_retailprice").cast("double").alias("p_retailprice"),
    )


@query(
    "sink_csv",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier",
)
def sink_csv(spark, sf):
    """Written lines without their headers, split at the separator."""
    supplier = a.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    path = sinks.write_csv(supplier, fresh_path(spark, "suppliers"))
    cells = F.split("value", ",")
    names = ["s_suppkey", "s_name", "s_nationkey"]
    lines = spark.read.text(path).where(~F.startswith(F.col("value"), F.lit("s_suppkey,")))
    return lines.select(*[F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(names)])
