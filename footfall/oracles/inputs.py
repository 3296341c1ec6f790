"""The derived input tables."""

_SHOP = "CASE WHEN l_linenumber <= 3 THEN (o_custkey * 31 + l_linenumber) % n ELSE l_suppkey END"

STEPS = {
    "n_shops": "SELECT count(*) AS n FROM supplier",
    "traffic": f"""
    SELECT 'g' || (o_custkey // 3) AS guid_str,
      CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE o_custkey END AS user_id,
      cast(o_custkey AS varchar) AS deviceid,
      shop_id, n_regionkey AS city_id,
      CASE WHEN l_partkey % 5 < 4 THEN 12 ELSE 7 END AS page_id,
      CASE WHEN l_linenumber <= 5 THEN 99 + l_linenumber ELSE l_linenumber - 6 END AS hp_log_type,
      strftime(o_orderdate, '%Y-%m-%d') AS hp_stat_time,
      CASE WHEN l_orderkey % 3 = 0
        THEN '/Search/keyword/' || n_regionkey || '/0_' || replace(p_name, ' ', '%20')
        ELSE '/shop/' || shop_id || CASE WHEN l_partkey % 10 = 0 THEN '/photos' ELSE '' END
      END AS path,
      CASE WHEN l_partkey % 3 > 0
        THEN '/search/keyword/'
          || CASE WHEN l_partkey % 10 = 1 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END
          || '/0_' || replace(p_name, ' ', '%20')
        ELSE '' END AS referer
    FROM (
      SELECT *, {_SHOP} AS shop_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN n_shops
    ) JOIN part ON l_partkey = p_partkey
      JOIN supplier ON shop_id = s_suppkey
      JOIN nation ON s_nationkey = n_nationkey""",
    "sized": "SELECT *, lower(p_type) || '-' || p_size AS sized FROM part",
    "words": """
    SELECT l_suppkey, unnest(list_append(string_split(p_name, ' '), sized)) AS word
    FROM lineitem JOIN sized ON l_partkey = p_partkey""",
    "packed": """
    SELECT l_suppkey AS tag_shop, string_agg(entry, ',' ORDER BY entry) AS shop_tags
    FROM (SELECT l_suppkey, word || ':' || count(*) AS entry FROM words GROUP BY l_suppkey, word)
    GROUP BY ALL""",
    "snap_shop": """
    SELECT s_suppkey AS shop_id,
      CASE s_suppkey % 3 WHEN 0 THEN 'Bar ' || s_suppkey WHEN 1 THEN 'Kitchen ' || s_suppkey
        ELSE s_name END AS shop_name,
      n_regionkey AS city_id,
      n_nationkey AS region_id, n_name AS region_name,
      r_regionkey AS district_id, r_name AS district_name,
      10 AS cat0_id, cast(s_suppkey % 6 AS integer) AS cat1_id,
      10 * (s_suppkey % 5 + 1) AS star, 5 * (s_suppkey % 3) AS power,
      cast(trunc(s_acctbal / 25) AS integer) AS avg_price,
      coalesce(shop_tags, '') AS shop_tags,
      CASE s_suppkey % 3 WHEN 0 THEN 'the:3,and:2,für:1,of the:2'
        WHEN 1 THEN 'of:1,is:4,none:1,à:2,红烧肉:1' ELSE 'the:1,is:1,de la:2,ó:1' END AS dish_tags
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN packed ON tag_shop = s_suppkey""",
    "dim_shop": """
    SELECT *, '3000-12-31' AS hp_valid_end_dt FROM snap_shop
    UNION ALL
    SELECT * REPLACE ((city_id + 1) % 5 AS city_id), '2000-01-01' FROM snap_shop""",
    "eligible": """
    SELECT * FROM dim_shop
    WHERE hp_valid_end_dt = '3000-12-31' AND star >= 30 AND power IN (5, 10)""",
    "searchable": """
    SELECT * FROM dim_shop
    WHERE hp_valid_end_dt = '3000-12-31' AND star >= 30 AND power > 3""",
    "vocabulary": """
    SELECT DISTINCT string_split(p_name, ' ')[1] AS tag, 'character' AS tagtype FROM part
    UNION
    SELECT DISTINCT string_split(p_name, ' ')[2], 'atmosphere' FROM part
    UNION
    SELECT DISTINCT sized, 'cuisine' FROM sized""",
    "reviews": """
    SELECT o_custkey AS userid, n_regionkey AS cityid, l_partkey AS shopid,
      10 * floor(l_quantity / 10) AS star
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "review_text": """
    SELECT doc_id AS reviewid, cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint) AS shopid,
      cast(cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint) % 5 AS integer) AS cityid,
      text AS reviewbody,
      strftime(date '2024-01-01' + cast(doc_id % 30 AS integer), '%Y-%m-%d') AS hp_statdate
    FROM documents""",
    "near": """
    SELECT l_suppkey AS a, cast((l_suppkey + 1 + floor(l_quantity / 4)) AS bigint) % n AS b,
      l_orderkey, l_discount
    FROM lineitem CROSS JOIN n_shops""",
    "item_edges": """
    SELECT sid1, sid2, count(*) / 100::double AS rank FROM (
      SELECT a AS sid1, b AS sid2 FROM near UNION ALL SELECT b, a FROM near
    ) WHERE sid1 <> sid2 GROUP BY ALL""",
    "shop_city": """
    SELECT s_suppkey AS shopid, n_regionkey AS cityid
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "feedback": """
    SELECT deviceid, cityid, shopid, score, updatetime FROM (
      SELECT cast(user_id AS varchar) AS deviceid,
        (user_id * 31 + cast(json_extract_string(props, '$.k') AS bigint)) % n AS shopid,
        value - 50 AS score, strftime(ts, '%Y-%m-%d') AS updatetime
      FROM events CROSS JOIN n_shops WHERE event_type IN ('error', 'click')
    ) JOIN shop_city USING (shopid)""",
    "promo": "SELECT s_suppkey AS shop_id, 1 + s_suppkey % 5 AS score FROM supplier",
    "accumulated": """
    SELECT deviceid, cityid, shopid, rank FROM (
      SELECT cast(o_custkey AS varchar) AS deviceid, b AS shopid, max(l_discount) AS rank
      FROM near JOIN orders ON l_orderkey = o_orderkey
      WHERE o_orderdate < timestamp '2001-05-01' GROUP BY ALL
    ) JOIN shop_city USING (shopid)""",
}
