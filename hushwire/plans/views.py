"""Derived tables that the queries run on, in SQL that Spark and the checking engine both read."""

from __future__ import annotations

PII_TEXT = """
SELECT c_custkey AS id, 'hello my name is ' || CASE c_custkey % 4 WHEN 0 THEN 'alice cooper' WHEN 1 THEN 'bob' WHEN 2 THEN 'john ronald smith' ELSE 'nurse kelly' END
 || '. mail user' || c_custkey || '@mail.example.com or www.site' || (c_custkey % 9) || '.org/a from 10.' || (c_custkey % 300) || '.3.4. call 415-555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
 || ' or ssn ' || substr(lpad(CAST(c_custkey AS STRING), 9, '1'), 1, 3) || '-' || substr(lpad(CAST(c_custkey AS STRING), 9, '1'), 4, 2) || '-' || substr(lpad(CAST(c_custkey AS STRING), 9, '1'), 6, 4)
 || ' dob ' || (1 + c_custkey % 12) || '/' || (1 + c_custkey % 28) || '/19' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || ' born march ' || (1 + c_custkey % 28) || ', 1980 zip ' || lpad(CAST(c_custkey % 100000 AS STRING), 5, '2')
 || ' aadhaar ' || lpad(CAST(c_custkey AS STRING), 4, '3') || ' ' || lpad(CAST(c_custkey % 9999 AS STRING), 4, '4') || ' 5678 cvv is ' || (100 + c_custkey % 900) || ' routing number ' || lpad(CAST(c_custkey AS STRING), 9, '7')
 || ' card 4111 1111 1111 ' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '1') || ' member id ABC' || c_custkey || ' my phone is four one five double five one two three four ' || CASE WHEN c_custkey % 3 = 0 THEN 'nine' ELSE 'thanks' END AS text
FROM customer"""

#: Four recognisers over the turns of the conversations, some rows empty, some failed.
ASR = """
SELECT conv_id * 1000 + turn AS file_id, 0 AS channel, e.engine AS engine, e.ord AS engine_ord,
 CASE WHEN e.ord = 3 AND turn % 7 = 0 THEN NULL WHEN e.ord = 0 THEN b WHEN e.ord = 1 THEN CASE WHEN turn % 5 = 1 THEN 'something else ' || b ELSE upper(b) END
  WHEN e.ord = 2 THEN CASE WHEN turn % 3 = 0 THEN b || ' indeed so it is said' ELSE b END ELSE CASE WHEN turn % 4 = 1 THEN 'quite another text here' ELSE b || '.' END END AS transcript,
 CASE WHEN e.ord = 3 AND turn % 7 = 0 THEN 'Timeout: no answer' END AS error
FROM (SELECT conv_id, turn, trim(regexp_replace(text, '[^A-Za-z ]+', ' '{g})) AS b FROM conversations) t
CROSS JOIN (SELECT 'alpha' AS engine, 0 AS ord UNION ALL SELECT 'beta', 1 UNION ALL SELECT 'gamma', 2 UNION ALL SELECT 'delta', 3) e"""

SPANS = """
SELECT l_orderkey AS file_id, l_linenumber % 3 - 1 AS channel, round(l_quantity * 0.1, 3) AS start, round(l_quantity * 0.1 + l_tax * 10, 3) AS {end},
 round(l_tax * 10, 3) AS duration, l_returnflag AS type, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE l_linestatus END AS text, l_linestatus AS source,
 l_linenumber * 1000000 + l_partkey AS ord FROM lineitem"""

CALLS = """
SELECT doc_id AS file_id, '/calls/' || source || '/' || CASE WHEN doc_id % 17 = 0 THEN 'tmp/' ELSE '' END || lpad(CAST(doc_id AS STRING), 9, '0') || '.wav' AS path, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE n_chars * 0.5 END AS duration,
 CAST(doc_id % 4 AS INT) AS channels, CASE WHEN doc_id % 3 = 0 THEN 'OPUS' ELSE 'wav' END AS codec, CASE WHEN doc_id % 2 = 0 THEN 48000 ELSE 8000 END AS rate FROM documents"""

#: Words of turns with times and character offsets by a running sum.
STATUS = """
SELECT o_custkey AS file_id, o_orderkey AS updated_at, CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'success_no_pii_fast_copy' END AS status,
 o_orderkey % 5 <> 0 AS valid FROM orders"""
