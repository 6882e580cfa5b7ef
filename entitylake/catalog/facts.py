"""The sample documents once more, as SQL over the flat tables.

The oracle never nests or flattens anything: each common table expression states directly which
attribute values and links the documents were built to hold.
"""

ATTRIBUTES = """
base AS (SELECT *, 'entities/' || c_custkey AS e FROM customer),
name_attr AS (
  SELECT c_custkey AS c, e || '/attributes/Name/n1' AS uri, c_name AS value, true AS ov,
         CAST(NULL AS VARCHAR) AS code
  FROM base WHERE c_acctbal >= 0),
segment_attr AS (
  SELECT c_custkey AS c, e || '/attributes/Segment/s1' AS uri, c_mktsegment AS value, true AS ov,
         substr(c_mktsegment, 1, 3) AS code FROM base
  UNION ALL
  SELECT c_custkey, e || '/attributes/Segment/s2', 'LEGACY' || c_nationkey, false, 'OLD'
  FROM base WHERE c_nationkey < 5),
unique_attr AS (
  SELECT c_custkey AS c, e || '/attributes/UniqueId/u1' AS uri, 'U' || c_custkey AS value,
         true AS ov, CAST(NULL AS VARCHAR) AS code FROM base),
reference_attr AS (
  SELECT c_custkey AS c, e || '/attributes/ReferenceId/r1' AS uri, 'R' || c_custkey AS value,
         true AS ov FROM base
  UNION ALL SELECT c_custkey, e || '/attributes/ReferenceId/r2', 'X' || c_custkey, false FROM base
  UNION ALL SELECT c_custkey, e || '/attributes/ReferenceId/r3', 'Q' || c_custkey, true
  FROM base WHERE c_nationkey = 7)"""

ADDRESSES = """
address_base AS (
  SELECT c_custkey AS c, 'a' || n AS a, n, c_nationkey AS nation, c_acctbal >= 0 AS solvent,
         'entities/' || c_custkey || '/attributes/Address/a' || n AS uri
  FROM customer, (VALUES (1), (2)) AS v(n) WHERE n = 1 OR c_nationkey % 2 = 0),
city_attr AS (
  SELECT c, a, uri || '/City/c1' AS uri, 'CITY' || nation || a AS value, true AS ov
  FROM address_base
  UNION ALL
  SELECT c, a, uri || '/City/c2', 'TOWN' || (c % 97) || a, solvent FROM address_base),
country_attr AS (
  SELECT c, a, uri || '/Country/k1' AS uri, 'Country ' || nation AS value, 'N' || nation AS code
  FROM address_base),
rank_attr AS (
  SELECT c, a, uri || '/Rank/r1' AS uri, CAST(n AS VARCHAR) AS value FROM address_base)"""

CROSSWALKS = """
records AS (
  SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS sid,
         CAST(o_orderkey AS VARCHAR) AS cross_value, CAST(o_custkey AS VARCHAR) AS entity,
         o_orderstatus AS source, 'a' || (1 + o_orderkey % 2) AS a, o_custkey AS c
  FROM orders),
listed AS (
  SELECT 'entities/' || entity || '/attributes/' || tail AS uri, sid, cross_value, source
  FROM (SELECT *, unnest(['Name/n1', 'Segment/s1', 'Segment/s2', 'UniqueId/u1',
                          'Address/' || a || '/City/c1', 'Address/' || a || '/City/c2',
                          'Address/' || a || '/Country/k1', 'Address/' || a || '/Rank/r1']) AS tail
        FROM records) AS t)"""

LINKED_ADDRESSES = """
linked AS (
  SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS crosswalks_value,
         CAST(o_custkey AS VARCHAR) AS entityid, o_orderstatus AS cross_source, lineitem.*
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'),
long AS (
  SELECT crosswalks_value, entityid, cross_source, 'City' AS part, 'City' AS leaf,
         'C' || l_returnflag AS value FROM linked WHERE l_quantity >= 10
  UNION ALL SELECT crosswalks_value, entityid, cross_source, 'City', 'City', 'B' || l_linestatus
  FROM linked WHERE l_tax < 0.04
  UNION ALL SELECT crosswalks_value, entityid, cross_source, 'Rank', 'Rank',
         CAST(l_linenumber AS VARCHAR) FROM linked
  UNION ALL SELECT crosswalks_value, entityid, cross_source, 'Zip_Zip4', 'Zip4',
         lpad(CAST(l_suppkey AS VARCHAR), 4, '0') FROM linked WHERE l_linestatus = 'O'
  UNION ALL SELECT crosswalks_value, entityid, cross_source, 'Zip_Zip5', 'Zip5',
         lpad(CAST(l_partkey AS VARCHAR), 5, '0') FROM linked
  UNION ALL SELECT crosswalks_value, entityid, cross_source, 'OriginalZip_Zip5', 'Zip5',
         lpad(CAST(l_partkey * 7 % 100000 AS VARCHAR), 5, '0') FROM linked WHERE l_quantity < 25)"""

SINGLE = f"""{ATTRIBUTES}, {CROSSWALKS},
attrs AS (SELECT uri, value, 'Name' AS label FROM name_attr
  UNION ALL SELECT uri, value, 'Segment' FROM segment_attr
  UNION ALL SELECT uri, value, 'UniqueId' FROM unique_attr),
single AS (
  SELECT source AS cross_source, cross_value, sid AS sourceid,
         split_part(attrs.uri, '/', 2) AS EntityID,
         max(value) FILTER (WHERE label = 'Name') AS "Name",
         max(value) FILTER (WHERE label = 'Segment') AS "Segment",
         max(value) FILTER (WHERE label = 'UniqueId') AS "UniqueId"
  FROM listed JOIN attrs ON listed.uri = attrs.uri GROUP BY ALL)"""

NESTED = f"""{ADDRESSES}, {CROSSWALKS},
nested_attrs AS (SELECT uri, value, 'City' AS label FROM city_attr
  UNION ALL SELECT uri, value, 'Rank' FROM rank_attr
  UNION ALL SELECT uri, value, 'Country' FROM country_attr)"""
