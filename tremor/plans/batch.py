"""Batch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions import messages as msg
from tremor.functions.places import location_key, location_label, upper_case
from tremor.functions.text import (
    characters,
    decimal_comma,
    filled,
    line_of,
    parts,
    quotes_to_spaces,
    words_of_lines,
)
from tremor.operators import bags, grouping, joins, matching, ranking
from tremor.plans import feeds
from tremor.plans.registry import registered
from tremor.sources import files
from tremor.sources.cities import cities
from tremor.sources.tables import number_range, table
from tremor.workspace import new_folder

# ---------------------------------------------------------------- sources


@registered(
    r"""
    WITH lines AS (
      SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM documents)
    SELECT length(line)::INT AS n_chars, count(*) AS n_lines FROM lines GROUP BY 1"""
)
def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(folder)
    lines = files.text_lines(spark, folder)
    return lines.groupBy(F.length("value").alias("n_chars")).agg(F.count(F.lit(1)).alias("n_lines"))


@registered(
    """
    SELECT l_linenumber::VARCHAR AS line_number, count(*) AS n_lines, round(sum(l_quantity + l_tax), 4) AS sum_qty
    FROM lineitem GROUP BY 1"""
)
def src_csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv-raw")
    lineitem = table(spark, sf_dir, "lineitem")
    quantity = (F.col("l_quantity") + F.col("l_tax")).alias("quantity")
    lineitem.select("l_orderkey", "l_linenumber", quantity).write.option("header", True).csv(folder)
    rows = files.raw_csv(spark, folder).where(~F.col("_c0").eqNullSafe("l_orderkey"))
    return rows.groupBy(F.col("_c1").alias("line_number")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(grouping.exact_sum("_c2"), 4).alias("sum_qty")
    )


@registered(
    f"""
    SELECT l_returnflag = 'R' AS cancelled, count(*) AS n_lines, round(sum({feeds.QUANTITY_SQL}), 4) AS sum_qty,
           round(fsum({feeds.PRICE_SQL}), 4) AS sum_price
    FROM lineitem GROUP BY 1"""
)
def src_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv-typed")
    feeds.retail_rows(spark, sf_dir).write.option("sep", ";").option("header", True).csv(folder)
    retail = files.retail_csv(spark, folder)
    return retail.groupBy(F.col("InvoiceNo").startswith("C").alias("cancelled")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(grouping.exact_sum("Quantity"), 4).alias("sum_qty"),
        F.round(grouping.exact_sum("UnitPrice"), 4).alias("sum_price"),
    )


@registered(
    """
    WITH bounds AS (SELECT unnest(range(0, 100, 5))::BIGINT AS band),
    sold AS (SELECT (floor(l_quantity / 5) * 5)::BIGINT AS band, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT band, coalesce(n, 0) AS n FROM bounds LEFT JOIN sold USING (band)"""
)
def src_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = number_range(spark, 0, 100, 5, "band")
    sold = table(spark, sf_dir, "lineitem").groupBy((F.floor(F.col("l_quantity") / 5) * 5).alias("band"))
    counts = sold.agg(F.count(F.lit(1)).alias("n"))
    return bands.join(counts, "band", "left").select("band", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@registered(
    f"""
    SELECT l_returnflag = 'R' AS cancelled, count(*) AS n_lines, round(sum({feeds.QUANTITY_SQL}), 4) AS sum_qty
    FROM lineitem GROUP BY 1"""
)
def header_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "header")
    feeds.retail_rows(spark, sf_dir).write.option("sep", ";").option("header", True).csv(folder)
    lines = files.text_lines(spark, folder).where(~F.col("value").contains("InvoiceNo"))
    pieces = _pieces(lines, ";")
    return pieces.groupBy(pieces.p[0].startswith("C").alias("cancelled")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(grouping.exact_sum(filled(pieces.p[3])), 4).alias("sum_qty")
    )


def _pieces(lines: DataFrame, sep: str) -> DataFrame:
    """``(p)``: each line's pieces. Behind an explode, so that every use shares one split."""
    return lines.select(F.explode(F.array(parts(F.col("value"), sep))).alias("p"))


# ---------------------------------------------------------------- JSON messages


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT id, text, place FROM messages WHERE place IS NOT NULL AND NOT broken"""
)
def json_extract_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.messages_with_place(feeds.message_lines(spark, sf_dir), need_text=True).select("id", "text", "place")


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT id, upper(split_part(location, ',', 1)) AS location FROM messages WHERE NOT broken"""
)
def json_extract_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = msg.parsed_messages(feeds.message_lines(spark, sf_dir))
    return messages.select("id", location_key(F.col("location")).alias("location"))


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT id, location FROM messages WHERE location IS NOT NULL AND NOT broken"""
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = msg.parsed_messages(feeds.message_lines(spark, sf_dir))
    return messages.where(F.col("location").isNotNull()).select("id", "location")


@registered(f"WITH {feeds.MESSAGES_SQL} SELECT id, replace(text, '''', ' ') AS text FROM messages")
def str_replace_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.message_rows(spark, sf_dir).select("id", quotes_to_spaces(F.col("text")).alias("text"))


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT id, text FROM messages
    WHERE NOT broken AND ((lon BETWEEN -130 AND 100 AND lat BETWEEN -20 AND 50) OR contains(text, 'deprem error'))"""
)
def filter_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = msg.parsed_messages(feeds.message_lines(spark, sf_dir))
    return messages.where(msg.subscription(term="deprem error")).select("id", "text")


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL}
    SELECT CASE WHEN NOT broken THEN location END AS location, count(CASE WHEN NOT broken THEN location END) AS n
    FROM messages GROUP BY 1 ORDER BY n DESC"""
)
def json_location_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = feeds.message_lines(spark, sf_dir)
    located = stored.select(msg.stored_location(F.col("value")).alias("location"))
    counts = located.groupBy("location").agg(F.count("location").alias("n"))
    return ranking.sorted_by(counts, "n", "location", descending=True)


@registered(
    rf"""
    WITH {feeds.MESSAGES_SQL},
    labels AS (
      SELECT split_part(array_to_string(list_transform(
          regexp_extract_all(whole, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),
          lambda w: upper(w[1]) || lower(w[2:])), ''), ',', 1) AS label, whole
      FROM (SELECT CASE WHEN NOT broken THEN location END AS whole FROM messages))
    SELECT label AS location, count(whole) AS n FROM labels GROUP BY label ORDER BY n DESC"""
)
def json_location_norm_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = feeds.message_lines(spark, sf_dir)
    located = stored.select(msg.stored_location(F.col("value")).alias("raw"))
    counts = located.groupBy("raw").agg(F.count("raw").alias("n"))
    labelled = counts.groupBy(location_label(F.col("raw")).alias("location")).agg(F.sum("n").alias("n"))
    return ranking.sorted_by(labelled, "n", "location", descending=True)


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL},
    keys AS (SELECT upper(split_part(location, ',', 1)) AS k FROM messages WHERE location IS NOT NULL AND NOT broken)
    SELECT id, city, count(k) AS n FROM cities LEFT JOIN keys ON k = upper(city) GROUP BY id, city"""
)
def dim_city_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_matches(spark, sf_dir, turkish=False)


_TURKISH_UPPER = "upper(replace(replace({0}, 'i', 'İ'), 'ı', 'I'))"


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL},
    keys AS (
      SELECT {_TURKISH_UPPER.format("split_part(location, ',', 1)")} AS k FROM messages
      WHERE location IS NOT NULL AND NOT broken)
    SELECT id, city, count(k) AS n FROM cities LEFT JOIN keys ON k = {_TURKISH_UPPER.format("city")} GROUP BY id, city"""
)
def dim_city_match_turkish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_matches(spark, sf_dir, turkish=True)


def _city_matches(spark: SparkSession, sf_dir: str, turkish: bool) -> DataFrame:
    messages = msg.parsed_messages(feeds.message_lines(spark, sf_dir)).where(F.col("location").isNotNull())
    facts = messages.select(location_key(F.col("location"), turkish).alias("k"))
    dimension = cities(spark).withColumn("city_key", upper_case(F.col("city"), turkish))
    return joins.dimension_counts(facts, dimension, "k", "city_key", "id").select("id", "city", "n")


@registered(
    f"""
    WITH {feeds.PLACES_SQL}
    SELECT location, count(*) AS location_count FROM places GROUP BY location"""
)
def parse_tagged_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    placed = events.join(feeds.user_places(spark, sf_dir), "user_id")
    text = F.concat(F.lit("#deprem "), "event_type", F.lit(" "), "props")
    lines = placed.select(msg.tagged_line(text, F.col("place")).alias("value"))
    return msg.tagged_places(lines).groupBy("location").agg(F.count(F.lit(1)).alias("location_count"))


# ---------------------------------------------------------------- projections and filters


@registered("SELECT p_partkey, p_size * p_size AS size_squared, upper(p_name) AS name_upper FROM part")
def proj_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        (F.col("p_size") * F.col("p_size")).alias("size_squared"),
        F.upper("p_name").alias("name_upper"),
    )


@registered("SELECT o_orderkey AS order_id, o_orderpriority AS priority FROM orders")
def proj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")
    )


@registered("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30")
def filter_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 30)
    return lines.select("l_orderkey", "l_linenumber", "l_quantity")


@registered("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@registered("SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 30 AND contains(p_name, 'ring')")
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (F.col("p_size") > 30) & F.col("p_name").contains("ring")
    return table(spark, sf_dir, "part").where(wanted).select("p_partkey", "p_name", "p_size")


@registered("SELECT count(*) AS n FROM part WHERE p_name LIKE '%ring%'")
def filter_like_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_name").contains("ring")).agg(F.count(F.lit(1)).alias("n"))


@registered(
    """
    SELECT n_nationkey AS id, n_name AS city, count(*) AS n
    FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_7' GROUP BY ALL"""
)
def filter_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city's users first: events of others are dropped before anything is counted or shuffled."""
    city = table(spark, sf_dir, "nation").where(F.col("n_name") == "NATION_7")
    users = table(spark, sf_dir, "customer").join(city, F.col("c_nationkey") == F.col("n_nationkey"))
    own = users.select(F.col("c_custkey").alias("user_id"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("city"))
    hits = table(spark, sf_dir, "events").select("user_id").join(own, "user_id")
    return hits.groupBy("id", "city").agg(F.count(F.lit(1)).alias("n"))


@registered(
    """
    SELECT c AS ch, count(*) AS n
    FROM (SELECT unnest(string_split(upper(p_name), '')) AS c FROM part) GROUP BY c"""
)
def explode_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = table(spark, sf_dir, "part").select(F.explode(characters(F.upper("p_name"))).alias("ch"))
    return chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


@registered(
    r"""
    WITH words AS (SELECT unnest(string_split_regex(text, '\r\n|\r|\n| ')) AS word FROM documents)
    SELECT word, count(*) AS n FROM words GROUP BY word"""
)
def wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.word_counts(table(spark, sf_dir, "documents"), words_of_lines(F.col("text")))


@registered(
    """
    WITH locations AS (
      SELECT n_name || ' ' || r_name AS location FROM events JOIN customer ON user_id = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(location, ' ')) AS word FROM locations) GROUP BY word"""
)
def location_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    regions = nation.join(region, nation.n_regionkey == region.r_regionkey)
    counts = feeds.place_counts(spark, sf_dir)
    located = counts.join(regions, counts.location == regions.n_name)
    return grouping.word_counts(
        located, F.split(F.concat("n_name", F.lit(" "), "r_name"), " "), weight=F.col("location_count")
    )


# ---------------------------------------------------------------- aggregations


@registered(
    f"""
    SELECT l_returnflag = 'R' AS cancelled, round(fsum(({feeds.QUANTITY_SQL}) * {feeds.PRICE_SQL}), 2) AS total
    FROM lineitem GROUP BY 1"""
)
def agg_cancelled_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _pieces(feeds.retail_lines(spark, sf_dir), ";")
    quantity = filled(pieces.p[3]).cast("double")
    sales = pieces.select(
        pieces.p[0].startswith("C").alias("cancelled"), (quantity * decimal_comma(pieces.p[5])).alias("total")
    )
    return sales.groupBy("cancelled").agg(F.round(grouping.exact_sum("total"), 2).alias("total"))


@registered(
    f"""
    SELECT l_partkey AS product_id, round(fsum({feeds.PRICE_SQL}), 4) AS sub_total
    FROM lineitem GROUP BY 1 ORDER BY sub_total DESC"""
)
def agg_sales_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = feeds.order_item_rows(spark, sf_dir)
    totals = items.groupBy("product_id").agg(F.round(grouping.exact_sum("sub_total"), 4).alias("sub_total"))
    return ranking.sorted_by(totals, "sub_total", "product_id", descending=True)


@registered(
    f"""
    WITH {feeds.JUDGEMENTS_SQL},
    latest AS (SELECT doc_id, arg_max(quality, revision) AS quality FROM judgements GROUP BY doc_id)
    SELECT doc_id, n_chars, quality FROM documents LEFT JOIN latest USING (doc_id)"""
)
def join_broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    latest = joins.latest_by_key(feeds.judgement_rows(spark, sf_dir), "doc_id", "quality", "revision")
    looked_up = joins.looked_up(documents, latest, "doc_id").select("doc_id", "n_chars", "quality")
    return ranking.sorted_by(looked_up, "n_chars", "doc_id", descending=True)


@registered(
    """
    SELECT c_mktsegment, round(fsum(c_acctbal) / count(c_acctbal), 6) AS avg_salary
    FROM customer GROUP BY 1"""
)
def agg_avg_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = grouping.exact_sum("c_acctbal") / F.count("c_acctbal")
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.round(mean, 6).alias("avg_salary"))


@registered(
    """
    WITH slices AS (
      SELECT o_orderpriority, ceil(count(*) / 1000.0)::BIGINT AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % n AS slice,
           string_agg(CASE WHEN o_orderstatus = 'P' THEN '-' ELSE (o_totalprice::DECIMAL(12,2))::VARCHAR END, ','
                      ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END NULLS LAST) AS order_values
    FROM orders JOIN slices USING (o_orderpriority) GROUP BY ALL"""
)
def agg_group_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(12,2)"))
    prices = table(spark, sf_dir, "orders").select("o_orderpriority", known.alias("price"), "o_orderkey")
    # A hash that SQL engines agree on; xxhash64 is the cheaper choice where they need not.
    spread = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8), 16, 10).cast("bigint")
    grouped = grouping.grouped_values(prices, "o_orderpriority", "price", spread, max_values=1000)
    as_text = F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("string"), F.lit("-"))), ",")
    return grouped.select("o_orderpriority", "slice", as_text.alias("order_values"))


@registered("SELECT c_custkey AS k, c_acctbal::DECIMAL(12,2)::DOUBLE * 100 AS v FROM customer")
def pair_map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    return pairs.withColumn("v", F.col("v") * 100)


@registered(
    """
    SELECT 'key' AS side, c_mktsegment AS item FROM customer
    UNION ALL SELECT 'value', c_name FROM customer"""
)
def pair_keys_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("k"), F.col("c_name").alias("v"))
    keys = pairs.select(F.lit("key").alias("side"), F.col("k").alias("item"))
    values = pairs.select(F.lit("value").alias("side"), F.col("v").alias("item"))
    return bags.bag_union(keys, values)


@registered("SELECT count(*) AS n FROM lineitem")
def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@registered("SELECT l_quantity AS item, count(*) AS n FROM lineitem GROUP BY 1")
def agg_count_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@registered(
    """
    SELECT round(fsum(l_quantity + l_tax), 4) AS sum_qty, round(fsum(l_extendedprice * (1 - l_discount)), 4) AS sum_price
    FROM lineitem"""
)
def agg_global_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(
        F.round(grouping.exact_sum(F.col("l_quantity") + F.col("l_tax")), 4).alias("sum_qty"),
        F.round(grouping.exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_price"),
    )


@registered(
    """
    SELECT n_name AS Country, round(fsum(o_totalprice), 4) AS UnitPrice
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1 ORDER BY 2 DESC"""
)
def sql_sum_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As SQL text. Orders are summed per customer before the join, so it shuffles a row per customer. The
    sums are exact to 80 binary places, as ``grouping.exact_sum`` makes them."""
    return spark.sql(
        """
        WITH cut AS (
          SELECT o_custkey, RINT(o_totalprice) AS whole, (o_totalprice - RINT(o_totalprice)) * POWER(2D, 40) AS rest
          FROM {orders}),
        spent AS (
          SELECT o_custkey, SUM(CAST(whole AS DECIMAL(38,0))) AS whole, SUM(CAST(RINT(rest) AS DECIMAL(20,0))) AS high,
                 SUM(CAST(RINT((rest - RINT(rest)) * POWER(2D, 40)) AS DECIMAL(20,0))) AS low
          FROM cut GROUP BY o_custkey)
        SELECT n_name AS Country,
               ROUND(CAST(SUM(whole) AS DOUBLE)
                 + (CAST(SUM(high) AS DOUBLE) + CAST(SUM(low) AS DOUBLE) / POWER(2D, 40)) / POWER(2D, 40), 4) AS UnitPrice
        FROM spent JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY UnitPrice DESC, Country""",
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


# ---------------------------------------------------------------- joins


@registered(
    """
    SELECT l_partkey::VARCHAR AS product_id, 'item ' || l_linenumber AS item_name, l_orderkey::VARCHAR AS order_id,
           CASE WHEN l_linenumber <> 6 THEN l_quantity END AS quantity, p_name AS product_name,
           CASE WHEN p_size > 10 THEN p_brand END AS product_brand
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
)
def join_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides come as lines; unknown fields are empty in them and NULL again after the split."""
    items = feeds.order_item_rows(spark, sf_dir)
    item_lines = items.select(line_of(",", "item_name", "order_id", "product_id", "quantity").alias("value"))
    parts_ = table(spark, sf_dir, "part").withColumn("brand", F.when(F.col("p_size") > 10, F.col("p_brand")))
    product_lines = parts_.select(line_of(",", "p_partkey", "p_name", "brand").alias("value"))
    item, product = _pieces(item_lines, ","), _pieces(product_lines, ",")
    left = item.select(
        filled(item.p[2]).alias("product_id"),
        filled(item.p[0]).alias("item_name"),
        filled(item.p[1]).alias("order_id"),
        filled(item.p[3]).cast("double").alias("quantity"),
    )
    right = product.select(
        filled(product.p[0]).alias("product_id"),
        filled(product.p[1]).alias("product_name"),
        filled(product.p[2]).alias("product_brand"),
    )
    return left.join(right, "product_id")


@registered(
    f"""
    WITH {feeds.JUDGEMENTS_SQL}
    SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM judgements) AS right_rows,
           (SELECT count(*) FROM documents JOIN judgements USING (doc_id))::DECIMAL(38,0) AS joined_rows,
           (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM judgements))
             AS left_without_partner,
           (SELECT count(*) FROM judgements WHERE doc_id NOT IN (SELECT doc_id FROM documents))
             AS right_without_partner"""
)
def join_integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return joins.key_match_counts(documents, feeds.judgement_rows(spark, sf_dir), "doc_id")


@registered(
    """
    SELECT c_custkey, v AS factor, c_nationkey * v AS product
    FROM customer CROSS JOIN (VALUES (2), (3), (5), (7), (11), (13)) AS t(v)"""
)
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = joins.paired_with(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), [2, 3, 5, 7, 11, 13], "factor"
    )
    return pairs.select("c_custkey", "factor", (F.col("c_nationkey") * F.col("factor")).alias("product"))


# ---------------------------------------------------------------- order


@registered("SELECT o_orderkey AS k, o_custkey AS v FROM orders ORDER BY k")
def sort_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))
    return ranking.sorted_by(pairs, "k")


@registered("SELECT o_orderpriority, o_orderkey FROM orders ORDER BY 1, 2")
def sort_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return ranking.sorted_by(orders, "o_orderpriority", "o_orderkey")


@registered(
    f"""
    WITH {feeds.PLACES_SQL}
    SELECT location, count(*) AS location_count FROM places GROUP BY location
    ORDER BY location_count DESC, location LIMIT 10"""
)
def topk_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_k(feeds.place_counts(spark, sf_dir), "location_count", 10, "location")


@registered("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def topk_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_k(prices, "o_totalprice", 3, "o_orderkey")


@registered("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 4")
def topk_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_k(prices, "o_totalprice", 4, "o_orderkey", descending=False)


@registered("SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 20")
def limit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ranking.top_k(events, "event_id", 20, descending=False)


# ---------------------------------------------------------------- bags and sets


def _order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bag with many NULLs: the customer of each order, unknown for pending ones."""
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(known.alias("id"))


def _event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user of each event, unknown for errors."""
    known = F.when(F.col("event_type") != "error", F.col("user_id"))
    return table(spark, sf_dir, "events").select(known.alias("id"))


_BAGS_SQL = """
a AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS id FROM orders),
b AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS id FROM events)
"""


@registered(f"WITH {_BAGS_SQL} SELECT id FROM a UNION ALL SELECT id FROM b")
def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.bag_union(_order_customers(spark, sf_dir), _event_users(spark, sf_dir))


@registered(f"WITH {_BAGS_SQL} SELECT id FROM a INTERSECT SELECT id FROM b")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.distinct_intersection(_order_customers(spark, sf_dir), _event_users(spark, sf_dir))


@registered(
    f"""
    WITH {_BAGS_SQL}
    SELECT id FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.id IS NOT DISTINCT FROM a.id)"""
)
def set_subtract_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bags.bag_subtract(_order_customers(spark, sf_dir), _event_users(spark, sf_dir))


@registered("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


# ---------------------------------------------------------------- strings


@registered(
    """
    SELECT p_partkey, p_brand || ' - ' || CASE WHEN p_size > 10 THEN p_type END AS label FROM part"""
)
def str_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_size") > 10, F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.lit(" - "), kind).alias("label"))


@registered("SELECT c_custkey, format('{:,.2f}', c_acctbal) AS formatted FROM customer")
def str_format_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.format_number("c_acctbal", 2).alias("formatted"))


@registered(
    """
    SELECT p_partkey, lower(p_type) AS type_lower, length(p_type)::INT AS type_length,
           array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
             AS name_initcap
    FROM part"""
)
def str_case_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower("p_type").alias("type_lower"),
        F.length("p_type").alias("type_length"),
        F.initcap("p_name").alias("name_initcap"),
    )


@registered(
    r"""
    WITH padded AS (SELECT p_partkey, '  ' || p_name || repeat(' ', p_size % 3) || chr(9) || '  ' AS city FROM part)
    SELECT p_partkey, rtrim(city, ' ') AS city_rtrim, ltrim(city, ' ') AS city_ltrim, trim(city, ' ') AS city_trim,
           length(trim(city, ' '))::INT AS city_length
    FROM padded"""
)
def str_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = F.repeat(F.lit(" "), F.col("p_size") % 3)
    padded = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", blanks, F.lit("\t  ")).alias("city")
    )
    return padded.select(
        "p_partkey",
        F.rtrim("city").alias("city_rtrim"),
        F.ltrim("city").alias("city_ltrim"),
        F.trim("city").alias("city_trim"),
        F.length(F.trim("city")).alias("city_length"),
    )


@registered("SELECT p_partkey, regexp_replace(p_name, 'n[gt]+', 'Ñö', 'g') AS replaced FROM part")
def str_regexp_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = F.regexp_replace("p_name", "n[gt]+", "Ñö")
    return table(spark, sf_dir, "part").select("p_partkey", replaced.alias("replaced"))


@registered(
    """
    WITH lists AS (
      SELECT p_partkey, string_split(coalesce(CASE WHEN p_size % 7 <> 0 THEN p_brand END, '') || '|' ||
             CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END || '|' ||
             CASE WHEN p_size % 11 = 0 THEN replace(p_name, ' ', '|') ELSE p_name END, '|') AS items
      FROM part)
    SELECT p_partkey, nullif(items[1], '') AS first_item, len(items)::INT AS n_items FROM lists"""
)
def str_split_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists whose first item may be unknown, whose second may be empty, and whose last may hold the separator."""
    size = F.col("p_size")
    listed = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size % 7 != 0, F.col("p_brand")).alias("brand"),
        F.when(size % 5 == 0, "").otherwise(F.col("p_type")).alias("type"),
        F.when(size % 11 == 0, F.replace("p_name", F.lit(" "), F.lit("|"))).otherwise(F.col("p_name")).alias("name"),
    )
    split = listed.select("p_partkey", parts(line_of("|", "brand", "type", "name"), "|").alias("items"))
    return split.select("p_partkey", filled(F.get("items", 0)).alias("first_item"), F.size("items").alias("n_items"))


# ---------------------------------------------------------------- sums, ranks and matches at any size


@registered(
    """
    SELECT l_returnflag, round(fsum(l_tax * 4e-13) * 1e9, 4) AS tiny, round(fsum(l_extendedprice * 1e12) / 1e12, 3) AS large,
           round(fsum(CASE WHEN l_linenumber = 3 THEN l_tax * 1e-12 ELSE l_quantity END), 6) AS mixed
    FROM lineitem GROUP BY 1"""
)
def agg_exact_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of values far below and far above one."""
    mixed = F.when(F.col("l_linenumber") == 3, F.col("l_tax") * 1e-12).otherwise(F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(grouping.exact_sum(F.col("l_tax") * 4e-13) * 1e9, 4).alias("tiny"),
        F.round(grouping.exact_sum(F.col("l_extendedprice") * 1e12) / 1e12, 3).alias("large"),
        F.round(grouping.exact_sum(mixed), 6).alias("mixed"),
    )


@registered(
    """
    SELECT o_orderkey, row_number() OVER w AS rank, sum(o_totalprice::DECIMAL(28,2)) OVER w AS running
    FROM orders WINDOW w AS (ORDER BY o_orderpriority, o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"""
)
def rank_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's place, and the total up to it, in an order whose first column has five values."""
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    orders = table(spark, sf_dir, "orders").select(*order, "o_totalprice")
    return ranking.running_totals(orders, order, "o_totalprice").select("o_orderkey", "rank", "running")


_NAMES_SQL = """
names AS (
  SELECT item_id AS name_id, substr(text, 9, 20) AS name FROM benchmark
  UNION ALL SELECT 1000 + item_id, substr(text, 1, 1 + (item_id % 6)::INT) FROM benchmark
  UNION ALL SELECT 2000 + doc_id, substr(text, 30, 12) FROM documents WHERE doc_id % 50 = 7)
"""


@registered(
    f"""
    WITH {_NAMES_SQL}
    SELECT doc_id, name_id FROM documents, names WHERE length(name) > 0 AND contains(text, name)"""
)
def join_contained_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain which names: passages of benchmark items and documents, and words of one to six characters."""
    benchmark, documents = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    item = F.col("item_id")
    passages = benchmark.select(item.alias("name_id"), F.substr("text", F.lit(9), F.lit(20)).alias("name"))
    words = benchmark.select((item + 1000).alias("name_id"), F.substr("text", F.lit(1), (item % 6 + 1).cast("int")).alias("name"))
    lines = documents.where("doc_id % 50 = 7").select(
        (F.col("doc_id") + 2000).alias("name_id"), F.substr("text", F.lit(30), F.lit(12)).alias("name")
    )
    names = passages.unionByName(words).unionByName(lines)
    texts = documents.select(F.col("doc_id").alias("key"), "text")
    return matching.contained_names(texts, names).withColumnRenamed("key", "doc_id")


@registered(
    f"""
    WITH {feeds.MESSAGES_SQL},
    subscriptions AS (
      SELECT c_custkey AS sub_id, CASE WHEN c_custkey % 9 = 0 THEN 'en' ELSE 'tr' END AS language,
             CASE WHEN c_custkey % 4 <> 1 THEN (c_custkey * 31 % 360 - 180)::DOUBLE END AS west,
             (c_custkey * 17 % 180 - 90)::DOUBLE AS south,
             (c_custkey * 31 % 360 - 180)::DOUBLE + c_custkey % 23 AS east,
             (c_custkey * 17 % 180 - 90)::DOUBLE + c_custkey % 11 AS north,
             CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'error''s {{"k": ' || c_custkey % 100 ELSE 'k": ' || c_custkey % 100 || '}}' END AS term
      FROM customer WHERE c_custkey % 10 < 3)
    SELECT sub_id, count(*) AS n FROM messages, subscriptions
    WHERE NOT broken AND language = 'tr' AND (coalesce(lon BETWEEN west AND east AND lat BETWEEN south AND north, FALSE)
                                              OR coalesce(contains(text, term), FALSE))
    GROUP BY sub_id"""
)
def join_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages each of many subscriptions wants, by box or by term."""
    key = F.col("c_custkey")
    west, south = (key * 31 % 360 - 180).cast("double"), (key * 17 % 180 - 90).cast("double")
    number = (key % 100).cast("string")
    term = F.when(key % 5 == 1, F.concat(F.lit('error\'s {"k": '), number)).when(
        key % 5 != 0, F.concat(F.lit('k": '), number, F.lit("}"))
    )
    subscriptions = table(spark, sf_dir, "customer").where("c_custkey % 10 < 3").select(
        key.alias("sub_id"),
        F.when(key % 9 == 0, "en").otherwise("tr").alias("language"),
        F.when(key % 4 != 1, west).alias("west"),
        south.alias("south"),
        (west + key % 23).alias("east"),
        (south + key % 11).alias("north"),
        term.alias("term"),
    )
    messages = msg.parsed_messages(feeds.message_lines(spark, sf_dir)).withColumnRenamed("id", "key")
    return matching.subscription_matches(messages, subscriptions, counted=True)
