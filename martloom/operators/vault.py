"""Hubs, links and satellites built from any frame of business keys."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import PART_SEPARATOR, joined_key, key_text, uuid5, with_keys
from martloom.functions.numeric import plain_number

# Fixed value: source label written into every vault row.
LOAD_SOURCE = "kafka_stg_msg"


def _stamped(load_dt: Column, load_src: str) -> list[Column]:
    return [load_dt.alias("load_dt"), F.lit(load_src).alias("load_src")]


def hub(df: DataFrame, pk: str, business_key: str, load_dt: Column, load_src: str,
        extra: list[str] | None = None) -> DataFrame:
    """One row per business key: ``pk, key, extra..., load_dt, load_src``; the first load wins."""
    held = [F.col(c) for c in (extra or [])]
    rows = df.filter(F.col(business_key).isNotNull()).select(
        F.col(business_key).cast("string").alias(business_key), *held, *_stamped(load_dt, load_src))
    earliest = rows.groupBy(business_key).agg(
        F.min(F.struct("load_dt", *held, "load_src")).alias("_first"))
    return with_keys(earliest, {pk: key_text(F.col(business_key))}).select(pk, business_key,
                           *[F.col(f"_first.{c}").alias(c) for c in [*(extra or []), "load_dt", "load_src"]])


def link(df: DataFrame, pk: str, ends: dict[str, str], load_dt: Column, load_src: str) -> DataFrame:
    """One row per pair of business keys; ``ends`` maps hub key names to business keys."""
    keys = list(ends.values())
    rows = df.groupBy(*keys).agg(F.min(load_dt).alias("load_dt"))
    texts = {pk: key_text(*[F.col(k) for k in keys]), **{end: key_text(F.col(key)) for end, key in ends.items()}}
    return with_keys(rows, texts).select(
        *texts, "load_dt", F.lit(load_src).alias("load_src"))


def satellite(df: DataFrame, pk: str, business_key: str, attributes: dict[str, str], hashdiff: str,
              load_dt: Column, load_src: str) -> DataFrame:
    """One row per distinct attribute set of a key; ``attributes`` maps output to input names.

    Fractional numbers are hashed as plain decimal text, without exponent or idle zeros.
    """
    text = {c: plain_number(F.col(c)) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes}
    inputs = list(attributes.values())
    rows = df.groupBy(business_key, *inputs).agg(F.min(load_dt).alias("load_dt"))
    hashed = with_keys(rows, {pk: key_text(F.col(business_key)), hashdiff: key_text(F.col(business_key), *[text[c] for c in inputs])})
    return hashed.select(
        pk, *[F.col(source).alias(name) for name, source in attributes.items()],
        "load_dt", F.lit(load_src).alias("load_src"), hashdiff)


def append_unseen(built: DataFrame, loaded: DataFrame | None, key: str) -> DataFrame:
    """Rows to append: those whose key the table does not hold (on conflict do nothing)."""
    return built if loaded is None else built.join(loaded.select(key), key, "left_anti").select(*built.columns)


def order_vault(messages: DataFrame, load_dt: Column | None = None, load_src: str = LOAD_SOURCE) -> dict[str, DataFrame]:
    """All hubs, satellites and links of nested order messages (column ``payload``), each built on its own."""
    flat = flat_orders(messages)
    return line_vault(flat.filter(_FIRST), flat.filter(_HAS_PRODUCT), load_dt, load_src)


def flat_orders(messages: DataFrame) -> DataFrame:
    """One row per message and product, numbered by ``_pos``; a message without products keeps a row."""
    return messages.select(*_order_columns(), F.posexplode_outer("payload.products").alias("_pos", "p")).select(
        "*", *_product_columns()).drop("p")


def _order_columns() -> list[Column]:
    return [F.col("payload.id").alias("order_id"), F.col("payload.date").alias("order_dt"),
            F.col("payload.status").alias("status"), F.col("payload.cost").alias("ordercost"),
            F.col("payload.payment").alias("payment"),
            F.col("payload.user.id").alias("user_id"), F.col("payload.user.name").alias("username"),
            F.col("payload.user.login").alias("userlogin"),
            F.col("payload.restaurant.id").alias("restaurant_id"), F.col("payload.restaurant.name").alias("restaurantname")]


def _product_columns() -> list[Column]:
    return [F.col("p.id").alias("product_id"), F.col("p.name").alias("productname"), F.col("p.category").alias("category_name")]


_FIRST, _HAS_PRODUCT = "coalesce(_pos, 0) = 0", "_pos IS NOT NULL"


def line_vault(order: DataFrame, line: DataFrame, load_dt: Column | None = None, load_src: str = LOAD_SOURCE) -> dict[str, DataFrame]:
    """The tables from flat columns: ``order`` has those of orders, ``line`` those of their lines; rows may repeat."""
    args = (F.current_timestamp() if load_dt is None else load_dt, load_src)
    sides = {"order": order, "line": line}
    built = {}
    for name, (side, kind, *described) in VAULT_TABLES.items():
        make = {"hub": hub, "link": link, "satellite": satellite}[kind]
        if kind == "hub":
            pk, business_key, extra = described
            built[name] = make(sides[side], pk, business_key, *args, extra=extra)
        else:
            built[name] = make(sides[side], *described, *args)
    return built


# The tables of the vault, from which columns they come, and how their own are called.
VAULT_TABLES = {
    "h_user": ("order", "hub", "h_user_pk", "user_id", []),
    "h_product": ("line", "hub", "h_product_pk", "product_id", []),
    "h_restaurant": ("order", "hub", "h_restaurant_pk", "restaurant_id", []),
    "h_order": ("order", "hub", "h_order_pk", "order_id", ["order_dt"]),
    "h_category": ("line", "hub", "h_category_pk", "category_name", []),
    "s_user_names": ("order", "satellite", "h_user_pk", "user_id", {"username": "username", "userlogin": "userlogin"},
                     "hk_user_names_hashdiff"),
    "s_restaurant_names": ("order", "satellite", "h_restaurant_pk", "restaurant_id", {"restaurantname": "restaurantname"},
                           "hk_restaurant_names_hashdiff"),
    "s_product_names": ("line", "satellite", "h_product_pk", "product_id", {"productname": "productname"}, "hk_product_names_hashdiff"),
    "s_order_status": ("order", "satellite", "h_order_pk", "order_id", {"status": "status"}, "hk_order_status_hashdiff"),
    "s_order_cost": ("order", "satellite", "h_order_pk", "order_id", {"ordercost": "ordercost", "payment": "payment"},
                     "hk_order_cost_hashdiff"),
    "l_order_product": ("line", "link", "hk_order_product_pk", {"h_order_pk": "order_id", "h_product_pk": "product_id"}),
    "l_order_user": ("order", "link", "hk_order_user_pk", {"h_order_pk": "order_id", "h_user_pk": "user_id"}),
    "l_product_category": ("line", "link", "hk_product_category_pk", {"h_product_pk": "product_id", "h_category_pk": "category_name"}),
    "l_product_restaurant": ("line", "link", "hk_product_restaurant_pk",
                             {"h_product_pk": "product_id", "h_restaurant_pk": "restaurant_id"}),
}


# Columns that are not text.
_KINDS = {"order_dt": "timestamp", "ordercost": "double", "payment": "double"}
_PLACES = ("first", "second", "third")
_MANY_OWNERS = ("order_id", "product_id")  # business keys so many that their rows hardly repeat within a task


def key_of(name: str) -> str:
    """The column that tells the rows of a table apart: its own key, or the hash of a satellite's attributes."""
    _, kind, pk, *described = VAULT_TABLES[name]
    return described[-1] if kind == "satellite" else pk


def _held(name: str) -> list[str]:
    """The columns of a table besides its key and the stamp, in order."""
    _, kind, pk, *described = VAULT_TABLES[name]
    if kind == "hub":
        return [described[0], *described[1]]
    return list(described[0]) if kind == "link" else [pk, *described[1]]


def vault_rows(messages: DataFrame, load_dt: Column | None = None, load_src: str = LOAD_SOURCE,
               once: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of all tables in one pass over nested messages: ``table, key``, up to three values as text, and the stamp.

    Rows repeat as often as they come; one shuffle by table and key leaves the first of each.  Until then keys are the
    short texts that are hashed, not the hashes, which are longer and cannot be compressed.
    ``vault_table`` hashes the keys and gives the columns back their names and types.  ``once`` may drop rows by table and
    key before they are stamped; values that the key spells out are left out until then.
    """
    flat = flat_orders(messages)
    there = {side: F.expr(_FIRST if side == "order" else _HAS_PRODUCT) for side in ("order", "line")}
    rows = _rows_of(flat, {name: there[side] for name, (side, *_) in VAULT_TABLES.items()})
    return _loaded(rows if once is None else _long(once(_short(rows))), load_dt, load_src)


def _rows_of(flat: DataFrame, tables: dict[str, Column], *kept: Column) -> DataFrame:
    """Flat columns as rows ``table, key`` and values of the tables, each where its condition holds, beside what is ``kept``."""
    made = []
    for name, there in tables.items():
        known, key, values = _row_of(name, flat)
        made.append(F.when(there & known, F.struct(F.lit(name).alias("table"), key.alias("key"), *[v.alias(c) for c, v in zip(_PLACES, values)])))
    return flat.select(*kept, F.explode(F.array_compact(F.array(*made))).alias("row")).select("*", "row.*").drop("row")


def _short(rows: DataFrame) -> DataFrame:
    """Rows without their values where these are the parts of the key, which is ``spelt`` then."""
    spelt = F.col("key") == F.concat_ws(PART_SEPARATOR, *_PLACES)
    for place in _PLACES:
        spelt &= ~F.coalesce(F.contains(F.col(place), F.lit(PART_SEPARATOR[0])), F.lit(False))
    return rows.withColumn("spelt", spelt).select("table", "key", "spelt", *[F.when(~F.col("spelt"), F.col(c)).alias(c) for c in _PLACES])


def _long(rows: DataFrame) -> DataFrame:
    """What ``_short`` was made of."""
    parts = F.split("key", re.escape(PART_SEPARATOR))
    return rows.select("table", "key", *[F.when(F.col("spelt"), F.get(parts, F.lit(i))).otherwise(F.col(c)).alias(c) for i, c in enumerate(_PLACES)])


def _row_of(name: str, flat: DataFrame) -> tuple[Column, list[Column], list[Column]]:
    """Whether flat columns make a row of a table, its key and its three values as text."""
    _, kind, pk, *described = VAULT_TABLES[name]
    text = {c: plain_number(F.col(c)) if of in ("double", "float") else F.col(c) for c, of in flat.dtypes}

    def as_text(column: str) -> Column:
        return (F.unix_micros(column) if _KINDS.get(column) == "timestamp" else F.col(column)).cast("string")

    there, columns = F.lit(True), _made_from(name)
    if kind == "hub":
        there, key = F.col(described[0]).isNotNull(), F.col(described[0]).cast("string")
    elif kind == "link":
        key = key_text(*[F.col(c) for c in columns])
    else:
        key = key_text(F.col(columns[0]), *[text[c] for c in columns[1:]])
    values = [as_text(c) for c in columns]
    return there, key, values + [F.lit(None).cast("string")] * (len(_PLACES) - len(values))


def _made_from(name: str) -> list[str]:
    """The flat columns that a table is made from, the business key that owns its rows first."""
    _, kind, _, *described = VAULT_TABLES[name]
    if kind == "hub":
        return [described[0], *described[1]]
    return list(described[0].values()) if kind == "link" else [described[0], *described[1].values()]


def _loaded(rows: DataFrame, load_dt: Column | None, load_src: str) -> DataFrame:
    return rows.withColumns({"load_dt": F.current_timestamp() if load_dt is None else load_dt, "load_src": F.lit(load_src)})


def distinct_vault_rows(messages: DataFrame, pieces: int, load_dt: Column | None = None, load_src: str = LOAD_SOURCE) -> DataFrame:
    """The rows of ``vault_rows``, of each table and key one.

    The tables that begin with the same business key are made where its columns lie, so what is shuffled is one narrow row
    for each message or product and business key, not a row for each table.  ``pieces`` parts are sorted one at a time.
    """
    sides = {"order": messages.select(*_order_columns()),
             "line": messages.select(F.explode("payload.products").alias("p"), *_order_columns()).select("*", *_product_columns()).drop("p")}
    groups: dict[tuple[str, str], list[str]] = {}
    for name, (side, *_) in VAULT_TABLES.items():
        groups.setdefault((side, _made_from(name)[0]), []).append(name)
    made = []
    for (side, owner), names in groups.items():
        facts = sides[side].select(*dict.fromkeys(c for name in names for c in _made_from(name)))
        # rows with one key lie together, also where it can be taken apart in several ways: by what comes before the first separator
        place = F.substring_index(F.concat(F.coalesce(F.col(owner), F.lit("None")), F.lit(PART_SEPARATOR)), PART_SEPARATOR, 1)
        if owner not in _MANY_OWNERS:
            facts = facts.distinct()  # few remain, and common ones are not sent again and again
        facts = facts.repartition(pieces, place)
        # copies go before the rows are sorted by key, and the sort is by place first, which tells most of them apart
        made.append(_rows_of(facts, {name: F.lit(True) for name in names}, place.alias("_place")).distinct()
                    .dropDuplicates(["_place", "table", "key"]).drop("_place"))
    return _loaded(reduce(DataFrame.unionByName, made), load_dt, load_src)


def vault_table(rows: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """One table out of the typed rows, with its own columns; ``plain`` leaves the keys of hubs and satellites unhashed, for joins."""
    hubs = () if plain else {pk for _, kind, pk, *_ in VAULT_TABLES.values() if kind == "hub"}

    def typed(column: str, place: str) -> Column:
        kind = _KINDS.get(column, "string")
        if column in hubs:
            return uuid5(F.col(place)).alias(column)
        value = F.timestamp_micros(F.col(place).cast("bigint")) if kind == "timestamp" else F.col(place).cast(kind)
        return value.alias(column)

    own = key_of(name)
    key = (F.col("key") if plain and VAULT_TABLES[name][1] != "link" else uuid5(F.col("key"))).alias(own)
    held, stamp = [typed(c, place) for c, place in zip(_held(name), _PLACES)], ["load_dt", "load_src"]
    ordered = [*held, *stamp, key] if VAULT_TABLES[name][1] == "satellite" else [key, *held, *stamp]
    return rows.filter(F.col("table") == name).select(*ordered)


def order_lines(vault: dict[str, DataFrame], plain: bool = False) -> DataFrame:
    """Order lines read back from the vault, with the latest status of each order.

    What describes orders and what describes products is joined first, each by itself, so the lines move twice only.
    With ``plain`` the tables have unhashed keys of hubs and satellites; the lines get theirs hashed at the end.
    """
    key = uuid5 if plain else (lambda column: column)

    def newest(table: DataFrame, pk: str, value: str, hashdiff: str) -> DataFrame:  # dealt out before the hash is there, which is long
        dealt = table.repartition(pk) if plain else table
        return dealt.groupBy(pk).agg(F.max_by(value, F.struct("load_dt", key(F.col(hashdiff)))).alias(value))

    latest = newest(vault["s_order_status"], "h_order_pk", "status", "hk_order_status_hashdiff")
    names = newest(vault["s_product_names"], "h_product_pk", "productname", "hk_product_names_hashdiff")

    def by_order(left: DataFrame, right: DataFrame) -> DataFrame:  # the hash of a missing order id is a key like any other
        right = right.withColumnRenamed("h_order_pk", "_order")
        return left.join(right, F.col("h_order_pk").eqNullSafe(F.col("_order"))).drop("_order")

    orders = by_order(vault["l_order_user"].select("h_order_pk", "h_user_pk").join(vault["h_user"].select("h_user_pk"), "h_user_pk"), latest)
    products = (vault["l_product_category"].select("h_product_pk", "h_category_pk")
                .join(vault["h_category"].select("h_category_pk", "category_name"), "h_category_pk")
                .join(vault["h_product"].select("h_product_pk"), "h_product_pk").join(names, "h_product_pk"))
    lines = by_order(vault["l_order_product"].select("h_order_pk", "h_product_pk"), orders).join(products, "h_product_pk")
    return lines.select(key(F.col("h_order_pk")).alias("h_order_pk"), key(F.col("h_user_pk")).alias("h_user_pk"),
                        key(F.col("h_product_pk")).alias("h_product_pk"), "productname",
                        key(F.col("h_category_pk")).alias("h_category_pk"), "category_name", "status")


def message_lines(messages: DataFrame) -> DataFrame:
    """Order lines straight from nested messages: the columns of ``order_lines`` without the joins.

    A line sent several times counts once and carries the status of the last message it
    came with; statuses sent at the same time go by name.
    """
    lines = messages.select(
        F.col("payload.id").alias("order_id"), F.col("payload.date").alias("order_dt"), F.col("payload.status").alias("status"),
        F.col("payload.user.id").alias("user_id"), F.explode("payload.products").alias("p"))
    once = lines.groupBy("order_id", "user_id", F.col("p.id").alias("product_id"), F.col("p.category").alias("category_name")).agg(
        F.max(F.col("p.name")).alias("productname"), F.max(F.struct("order_dt", "status"))["status"].alias("status"))
    return once.select(
        joined_key(F.col("order_id")).alias("h_order_pk"), joined_key(F.col("user_id")).alias("h_user_pk"),
        joined_key(F.col("product_id")).alias("h_product_pk"), "productname",
        joined_key(F.col("category_name")).alias("h_category_pk"), "category_name", "status")
