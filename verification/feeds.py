"""The driver tables in the shapes the layers work on.

Each feed is derived row by row from a given table with plain expressions, so
its size follows the table. ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.schemas import CDC_TABLES

L, S, I, D, N = T.LongType(), T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()

TABLES = {
    "region": [("r_regionkey", I), ("r_name", S)],
    "nation": [("n_nationkey", I), ("n_name", S), ("n_regionkey", I)],
    "customer": [("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                 ("c_mktsegment", S)],
    "part": [("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
             ("p_retailprice", D)],
    "orders": [("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
               ("o_orderdate", N), ("o_orderpriority", S)],
    "lineitem": [("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                 ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                 ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", N)],
    "events": [("event_id", L), ("ts", N), ("user_id", L), ("event_type", S), ("value", D),
               ("props", S)],
}

SNAPSHOT_DAYS = ("2001-08-01", "2001-08-02", "2001-08-03")
ORIGIN = "timestamp '1995-01-01 00:00:00'"
Y1997, Y1999 = "timestamp '1997-01-01 00:00:00'", "timestamp '1999-01-01 00:00:00'"
CLICK_TOPIC = "events.v1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; wall-clock times become UTC instants."""
    schema = T.StructType([T.StructField(c, t) for c, t in TABLES[name]])
    rows = spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
    times = {c: F.col(c).cast("timestamp") for c, t in TABLES[name] if t == N}
    return rows.withColumns(times) if times else rows


def dealt(rows: DataFrame) -> DataFrame:
    """Rows spread over as many tasks as a shuffle has.

    A row becomes several records of long text, so a table that is one small
    file would else be one long task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _days(at: str, days: str) -> str:
    return f"timestamp_micros(unix_micros({at}) + cast({days} as bigint) * 86400000000)"


def _seconds(at: str, seconds: str) -> str:
    return f"timestamp_micros(unix_micros({at}) + cast({seconds} as bigint) * 1000000)"


def _sku(key: str) -> str:
    digits = f"cast({key} as string)"
    padded = f"if(length({digits}) < 6, lpad({digits}, 6, '0'), {digits})"
    return f"concat_ws('-', upper(left(p_type, 3)), upper(left(p_brand, 3)), {padded})"


EMAIL = "concat(lower(replace(c_name, '#', '.')), '@example.com')"


# ---------------------------------------------------------------------------
# Daily snapshots
# ---------------------------------------------------------------------------
def order_snapshots(orders: DataFrame) -> DataFrame:
    """Three days of full order copies; the status moves on by key."""
    return (
        orders.selectExpr("*", "explode(array(0, 1, 2)) as day")
        .selectExpr(
            "*", "least(day, o_orderkey % 3) as step",
            "case o_orderstatus when 'F' then 3 when 'P' then 1 else 0 end as base",
        )
        .selectExpr(
            "o_orderkey as order_id",
            "if(o_orderkey % 23 <> 5, o_custkey, null) as customer_id",
            "case when day = 2 and o_orderkey % 29 = 3 then 'cancelled' "
            "else array('pending', 'paid', 'shipped', 'delivered')"
            "[cast(least(base + step, 3) as int)] end as status",
            "'USD' as currency",
            "o_totalprice as total_amount",
            "o_orderdate as created_at",
            f"{_days('o_orderdate', 'step')} as updated_at",
            "array{}[day] as ds".format(SNAPSHOT_DAYS),
        )
    )


def item_snapshots(lineitem: DataFrame) -> DataFrame:
    """Two days of order items; the older day lacks what shipped late.

    There is no natural item id; the grain is written out as text. The unit
    price is the extended price per piece, rounded half up on whole cents.
    """
    return lineitem.selectExpr(
        "*", "cast(round(l_extendedprice * 100) as bigint) as cents",
        "cast(l_quantity as bigint) as pieces",
    ).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "date_format(l_shipdate, 'yyyyMMdd')) as order_item_id",
        "l_orderkey as order_id",
        "l_partkey as product_id",
        "cast(l_quantity as int) as quantity",
        "((2 * cents + pieces) div (2 * pieces)) / 100.0D as unit_price_at_purchase",
        "explode(if(l_shipdate < timestamp '2000-01-01 00:00:00', "
        f"array{SNAPSHOT_DAYS[1:]}, array('{SNAPSHOT_DAYS[2]}'))) as ds",
    )


def product_snapshots(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as product_id",
        f"{_sku('p_partkey')} as sku",
        "p_name as name",
        "p_type as category",
        "p_brand as subcategory",
        "p_retailprice as unit_price",
        "p_size % 10 <> 0 as is_active",
        f"{ORIGIN} as created_at",
        f"{_days(ORIGIN, 'if(p_partkey % 4 = 0, 30, 0)')} as updated_at",
        f"'{SNAPSHOT_DAYS[2]}' as ds",
    )


def customer_snapshots(customer: DataFrame, nation: DataFrame) -> DataFrame:
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "c_custkey as customer_id",
        f"{EMAIL} as email",
        "c_name as full_name",
        "n_name as country_code",
        "c_acctbal > 5000 as marketing_opt_in",
        f"{ORIGIN} as created_at",
        f"{ORIGIN} as updated_at",
        f"'{SNAPSHOT_DAYS[2]}' as ds",
    )


# ---------------------------------------------------------------------------
# Change feeds
# ---------------------------------------------------------------------------
def _records(
    rows: DataFrame, name: str, key: str, changes: list[str], image: dict[str, str],
    varying: dict[str, tuple[str, str]], bare: bool = False,
) -> DataFrame:
    """Explode the changes of each row and wrap them as log records.

    ``image`` maps column to text expression; ``varying`` maps column to its
    fields in a change, after and before it. ``bare`` records have no value, for
    readers of the message key alone.
    """
    def struct(side: int) -> str:
        fields = {**image, **{c: f"c.{names[side]}" for c, names in varying.items()}}
        ordered = [f"'{c}', {fields[c]}" for c in CDC_TABLES[name].columns]
        return f"named_struct({', '.join(ordered)})"

    opened = (rows if bare else dealt(rows)).selectExpr(
        "*", f"explode(filter(array({', '.join(changes)}), c -> c is not null)) as c"
    )
    body = (
        f"to_json(named_struct('before', if(c.op in ('u', 'd'), {struct(1)}, null), "
        f"'after', if(c.op <> 'd', {struct(0)}, null), 'op', c.op, "
        "'ts_ms', unix_millis(c.at)), map('ignoreNullFields', 'false'))"
    )
    value = "null" if bare else f"if(c.op <> 't', {body}, null)"
    # The record is generated, not projected: filters of the layers above then
    # see a stored value, as on a real log, and do not rebuild the text.
    return opened.selectExpr(
        f"cast(cast({key} as string) as binary) as key",
        f"explode(array(cast({value} as binary))) as value",
        f"'{CDC_TABLES[name].topic}' as topic",
        f"cast({key} % 4 as int) as partition",
        f"{key} * 8 + c.n as offset",
        "c.at as timestamp",
    )


def _change(n: int, op: str, at: str, **values: str) -> str:
    fields = "".join(f", '{c}', cast({v} as string)" for c, v in values.items())
    return f"named_struct('n', {n}, 'op', {op}, 'at', {at}{fields})"


def _if(condition: str, change: str) -> str:
    return f"if({condition}, {change}, null)"


def _iso(at: str) -> str:
    return f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def order_changes(orders: DataFrame, drift: bool = False, bare: bool = False) -> DataFrame:
    """Create, pay, deliver, erase, delete, tombstone; with ties and repeats."""
    base = orders.selectExpr(
        "o_orderkey as k", "o_orderdate as made", "o_orderstatus = 'F' as f",
        "o_custkey as who",
        "cast(cast(if(o_orderkey % 500 = 1, -o_totalprice, o_totalprice) as decimal(12,2)) "
        "as string) as total",
    ).selectExpr("*", "if(f and k % 13 = 0, null, who) as last_who")

    def change(n, op, at, status="null", who="null", old_status="null", old_who="null"):
        return _change(n, op, at, status=status, who=who, old_status=old_status, old_who=old_who)

    pay = change(
        1, "'u'", f"if(k % 17 = 0, made, {_days('made', '1')})", "'paid'", "who", "'pending'", "who"
    )
    sent, gone = _days("made", "2"), _days("made", "3")
    changes = [
        change(0, "if(k % 7 = 0, 'r', 'c')", "made", "'pending'", "who"),
        pay,
        _if("k % 19 = 0", pay),
        _if("f", change(2, "'u'", sent, "'delivered'", "last_who", "'paid'", "who")),
        _if("k % 10 = 0", change(
            3, "'d'", gone, old_status="if(f, 'delivered', 'paid')", old_who="last_who")),
        _if("k % 10 = 0", change(4, "'t'", gone)),
    ]
    image = {
        "order_id": "cast(k as string)", "currency": "'USD'", "total_amount": "total",
        "created_at": _iso("made"), "updated_at": _iso("c.at"),
    }
    varying = {"customer_id": ("who", "old_who"), "status": ("status", "old_status")}
    feed = _records(base, "orders", "k", changes, image, varying, bare)
    if not drift:
        return feed
    # An upstream release added columns to some rows.
    return feed.selectExpr(
        "key",
        "cast(case when cast(cast(key as string) as bigint) % 97 = 0 then "
        """replace(cast(value as string), '"after":{', '"after":{"channel":"web",') """
        "when cast(cast(key as string) as bigint) % 101 = 0 then "
        """replace(cast(value as string), '"after":{', '"after":{"loyalty":"1","channel":"app",') """
        "else cast(value as string) end as binary) as value",
        "topic", "partition", "offset", "timestamp",
    )


def product_changes(part: DataFrame, bare: bool = False) -> DataFrame:
    """Price changes, changes of nothing, two changes at one instant, deletes."""
    base = part.selectExpr(
        "p_partkey as p", f"{_sku('p_partkey')} as sku", "p_name", "p_type", "p_brand",
        "cast(p_size % 10 <> 0 as string) as active",
        "cast(round(p_retailprice * 100) as bigint) as cents",
        f"{_days(Y1997, 'p_partkey % 365')} as t1",
        f"{_days(Y1999, 'p_partkey % 200')} as t3",
    )

    def price(tenths: int) -> str:
        return f"cast(cast(cents * {tenths} div 10 as decimal(12,0)) / 100 as decimal(10,2))"

    changes = [
        _change(0, "'c'", ORIGIN, price=price(10), old=price(10)),
        _change(1, "'u'", "t1", price=price(11), old=price(10)),
        _change(2, "'u'", _days("t1", "30"), price=price(11), old=price(11)),
        _if("p % 3 = 0", _change(3, "'u'", "t3", price=price(12), old=price(11))),
        _if("p % 6 = 0", _change(4, "'u'", "t3", price=price(13), old=price(12))),
        _if("p % 50 = 0", _change(
            5, "'d'", "timestamp '2000-06-01 00:00:00'", price=price(11), old=price(11))),
    ]
    image = {
        "product_id": "cast(p as string)", "sku": "sku", "name": "p_name", "category": "p_type",
        "subcategory": "p_brand", "is_active": "active", "created_at": _iso(ORIGIN),
        "updated_at": _iso("c.at"),
    }
    return _records(base, "products", "p", changes, image, {"unit_price": ("price", "old")}, bare)


def customer_changes(customer: DataFrame, bare: bool = False) -> DataFrame:
    """Moves to another country, changes of nothing, erasures."""
    base = customer.selectExpr(
        "c_custkey as k", "c_name", f"{EMAIL} as email",
        "cast(c_acctbal > 5000 as string) as opt_in",
        "lpad(cast(c_nationkey as string), 2, '0') as home",
        "lpad(cast((c_nationkey + 1) % 25 as string), 2, '0') as away",
        f"{_days(Y1997, 'c_custkey % 300')} as moved",
    )
    erased = "timestamp '2000-01-01 00:00:00'"
    changes = [
        _change(0, "'c'", ORIGIN, country="home", old="home"),
        _if("k % 4 = 0", _change(1, "'u'", "moved", country="away", old="home")),
        _if("k % 8 = 0", _change(2, "'u'", _days("moved", "10"), country="away", old="away")),
        _if("k % 9 = 0", _change(
            3, "'d'", erased, country="home", old="if(k % 4 = 0, away, home)")),
        _if("k % 9 = 0", _change(4, "'t'", erased, country="home", old="home")),
    ]
    image = {
        "customer_id": "cast(k as string)", "email": "email", "full_name": "c_name",
        "marketing_opt_in": "opt_in", "created_at": _iso(ORIGIN), "updated_at": _iso("c.at"),
    }
    return _records(
        base, "customers", "k", changes, image, {"country_code": ("country", "old")}, bare)


# ---------------------------------------------------------------------------
# Click log
# ---------------------------------------------------------------------------
# Driver event types in terms of the data contract.
EVENT_NAMES = (
    "case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart' "
    "when 'signup' then 'begin_checkout' when 'error' then 'page_view' else event_type end"
)


def click_log(events: DataFrame) -> DataFrame:
    """Click records as they arrive: repeats, late events, seven kinds of damage.

    Damage sits where ``event_id % 50 = 7``: no header, no value, one byte, or
    a payload that is cut early or late, holds a value of another type, or goes
    on behind its end. Some of the records without header were sent again.
    """
    late = "if(event_id % 50 = 3, -(60 + event_id % 240), 0)"
    buys = "event_type = 'purchase'"
    payload = f"""to_json(named_struct(
        'event_id', cast(event_id as string),
        'event_type', {EVENT_NAMES},
        'event_ts', unix_millis({_seconds('ts', late)}),
        'session_id', if(event_id % 90 <> 5, concat(user_id, '-', date_format(ts, 'dd')), null),
        'customer_id', if(user_id % 3 <> 0, user_id, null),
        'device', named_struct(
            'type', array('mobile', 'desktop', 'tablet')[cast(user_id % 3 as int)],
            'os', array('android', 'linux', 'ios')[cast(user_id % 3 as int)],
            'browser', array('firefox', 'chrome')[cast(user_id % 2 as int)]),
        'page_url', concat('/item/', k),
        'referrer', if(event_id % 2 = 1, '/home', null),
        'properties', map_from_entries(filter(array(
            named_struct('name', 'product_id', 'value', k),
            if({buys} and event_id % 30 <> 3, named_struct('name', 'order_id',
                'value', cast(event_id * 2 as string)), null),
            if({buys}, named_struct('name', 'order_value', 'value', cast(value as string)), null)
        ), entry -> entry is not null))))"""
    header = "X'0000000001'"
    return (
        dealt(events).selectExpr("*", "get_json_object(props, '$.k') as k")
        .selectExpr(
            "event_id", "user_id", "ts", f"{payload} as text",
            "explode(if(event_id % 50 = 0 or event_id % 600 = 7, array(0, 1), array(0))) as copy",
        )
        .selectExpr("*", "cast(text as binary) as payload")
        .selectExpr(
            "cast(cast(user_id as string) as binary) as key",
            f"""explode(array(case if(copy = 0, event_id % 200, null)
                when 7 then payload
                when 57 then null
                when 107 then X'00'
                when 157 then concat({header}, cast(case event_id % 800
                    when 157 then concat('{{"event_id": "', event_id)
                    when 357 then left(text, instr(text, '"device"') + 9)
                    when 557 then regexp_replace(text, '"event_ts":[0-9]+', '"event_ts":"soon"')
                    else concat(text, '}}') end as binary))
                else concat({header}, payload) end)) as value""",
            f"'{CLICK_TOPIC}' as topic",
            "cast(user_id % 3 as int) as partition",
            "event_id * 2 + copy as offset",
            f"{_seconds('ts', '1 + 60 * copy')} as timestamp",
        )
    )
