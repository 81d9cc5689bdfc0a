"""Pieces of SQL the oracles share."""

RX = r"[\p{L}\p{N}_]+(?:[''’.][\p{L}\p{N}_]+)*"


def words(column: str) -> str:
    """Standard tokens of a column as a list."""
    return f"regexp_extract_all(lower({column}), '{RX}')"


def letters(column: str) -> str:
    return rf"regexp_extract_all(lower({column}), '\p{{L}}+')"


# Given tok(doc_id, ord, property_id, term): BM25 of every (doc, ord, property, term).
BM25 = """
  len AS (SELECT doc_id, ord, property_id, count(*) AS len FROM tok GROUP BY ALL),
  fs AS (SELECT property_id, count(*) AS n, avg(len) AS al FROM len GROUP BY ALL),
  tf AS (SELECT doc_id, ord, property_id, term, count(*) AS tf FROM tok GROUP BY ALL),
  df AS (SELECT property_id, term, count(*) AS df FROM tf GROUP BY ALL),
  sc AS (SELECT tf.*, len, df, n, al, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf,
           tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al)) AS tfn,
           ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al)) AS s
         FROM tf JOIN len USING (doc_id, ord, property_id) JOIN df USING (property_id, term)
         JOIN fs USING (property_id))"""

DOC_TOK = f"""tok AS (
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, '0' AS ord, 'text' AS property_id, unnest({words('text')}) AS term
    FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR), '0', 'lang', lang FROM documents)"""
DOC_SET = "(SELECT CAST(doc_id AS VARCHAR) AS doc_id, source AS set_id, n_chars FROM documents)"


def part_tok(name: bool = True, kind: bool = True, kind_standard: bool = False) -> str:
    parts = []
    if name:
        parts.append(f"SELECT CAST(p_partkey AS VARCHAR) AS doc_id, '0' AS ord, 'p_name' AS property_id, "
                     f"unnest({words('p_name')}) AS term FROM part")
    if kind:
        term = f"unnest({words('p_type')})" if kind_standard else "p_type"
        parts.append(f"SELECT CAST(p_partkey AS VARCHAR), '0', 'p_type', {term} FROM part")
    return "tok AS (" + " UNION ALL ".join(parts) + ")"


PART_SET = "(SELECT CAST(p_partkey AS VARCHAR) AS doc_id, p_brand AS set_id FROM part)"

LAT = "(CAST(c_custkey * 37 % 1800 AS DOUBLE) / 10 - 90)"
LON = "(CAST(c_custkey * 91 % 3600 AS DOUBLE) / 10 - 180)"
LINK = "'L' || CAST(c_custkey // 5 AS VARCHAR)"
# Every element of the customer type: normal documents, then linked ones.
ELEMENTS = f"""el AS (
    SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_mktsegment AS set_id, '0' AS ord, c_mktsegment AS eset, c_custkey,
      c_name, c_acctbal, c_nationkey, {LAT} AS lat, {LON} AS lon,
      TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS last_write FROM customer
    UNION ALL
    SELECT {LINK}, NULL, c_mktsegment || '/' || c_custkey, c_mktsegment, c_custkey,
      c_name, c_acctbal, c_nationkey, {LAT}, {LON}, TIMESTAMP '2024-01-01' + to_seconds(c_custkey) FROM customer)"""
CUSTOMER_TOK = f"""tok AS (
    SELECT doc_id, ord, 'c_name' AS property_id, unnest({words('c_name')}) AS term FROM el
    UNION ALL SELECT doc_id, ord, 'segment', eset FROM el)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )


def osa(x: str, y: str) -> str:
    """Edit distance with adjacent transpositions up to two, NULL above."""
    swap = f"substr({x},CAST(i AS INT),1) = substr({y},CAST(i AS INT)+1,1) AND substr({x},CAST(i AS INT)+1,1) = substr({y},CAST(i AS INT),1)"
    swap_j = swap.replace("CAST(i AS INT)", "CAST(j AS INT)")
    pre = f"substr({x},1,CAST(i AS INT)-1) = substr({y},1,CAST(i AS INT)-1)"
    one = (
        f"(levenshtein({x},{y}) <= 1 OR (length({x}) = length({y}) AND len(list_filter(range(1, length({x})), lambda i: "
        f"{swap} AND {pre} AND substr({x},CAST(i AS INT)+2) = substr({y},CAST(i AS INT)+2))) > 0))"
    )
    two = (
        f"(levenshtein({x},{y}) <= 2 OR (damerau_levenshtein({x},{y}) <= 2 AND ("
        f"len(list_filter(range(1, length({x})), lambda i: len(list_filter([-1,0,1], lambda o: i+o >= 1 AND i+o < length({y}) "
        f"AND substr({x},CAST(i AS INT),1) = substr({y},CAST(i+o AS INT)+1,1) AND substr({x},CAST(i AS INT)+1,1) = substr({y},CAST(i+o AS INT),1) "
        f"AND levenshtein(substr({x},1,CAST(i AS INT)-1), substr({y},1,CAST(i+o AS INT)-1)) "
        f"+ levenshtein(substr({x},CAST(i AS INT)+2), substr({y},CAST(i+o AS INT)+2)) <= 1)) > 0)) > 0 "
        f"OR (length({x}) = length({y}) AND len(list_filter(range(1, length({x})), lambda i: {swap} AND {pre} AND "
        f"len(list_filter(range(i+2, length({x})), lambda j: {swap_j} AND substr({x},CAST(i AS INT)+2,CAST(j-i AS INT)-2) = "
        f"substr({y},CAST(i AS INT)+2,CAST(j-i AS INT)-2) AND substr({x},CAST(j AS INT)+2) = substr({y},CAST(j AS INT)+2))) > 0)) > 0))))"
    )
    return f"CASE WHEN {x} = {y} THEN 0 WHEN {one} THEN 1 WHEN {two} THEN 2 END"


def auto(token: str) -> str:
    return f"CASE WHEN length({token}) < 3 THEN 0 WHEN length({token}) <= 5 THEN 1 ELSE 2 END"
