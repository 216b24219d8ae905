"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from itertools import combinations

from lakeloom.sources.triples import SAMPLE_ROWS

VIEWS = """
kg_facts AS (
  SELECT '<customer_' || c_custkey || '>' AS subject, '<livesIn>' AS predicate,
         '<nation_' || c_nationkey || '>' AS cat_object, CAST(NULL AS DOUBLE) AS num_object FROM customer
  UNION ALL SELECT '<customer_' || c_custkey || '>', '<hasMarketSegment>', '<' || replace(c_mktsegment, ' ', '_') || '>', NULL FROM customer
  UNION ALL SELECT '<customer_' || o_custkey || '>', '<placedOrder>', '<order_' || o_orderkey || '>', NULL FROM orders
  UNION ALL SELECT '<order_' || o_orderkey || '>', '<hasStatus>', '<' || replace(o_orderstatus, ' ', '_') || '>', NULL FROM orders
  UNION ALL SELECT '<order_' || o_orderkey || '>', '<hasPriority>', '<' || replace(o_orderpriority, ' ', '_') || '>', NULL FROM orders
  UNION ALL SELECT '<order_' || l_orderkey || '>', '<containsPart>', '<part_' || l_partkey || '>', NULL FROM lineitem
  UNION ALL SELECT '<supplier_' || s_suppkey || '>', '<isLocatedIn>', '<nation_' || s_nationkey || '>', NULL FROM supplier
  UNION ALL SELECT '<nation_' || n_nationkey || '>', '<isLocatedIn>', '<region_' || n_regionkey || '>', NULL FROM nation
  UNION ALL SELECT '<part_' || p_partkey || '>', '<hasBrand>', '<' || replace(p_brand, ' ', '_') || '>', NULL FROM part
  UNION ALL SELECT '<part_' || p_partkey || '>', '<hasPartType>', '<' || replace(p_type, ' ', '_') || '>', NULL FROM part
),
kg_literal_facts AS (
  SELECT '<customer_' || c_custkey || '>' AS subject, '<hasAccountBalance>' AS predicate,
         CAST(NULL AS VARCHAR) AS cat_object, CAST(c_acctbal AS DOUBLE) AS num_object FROM customer
  UNION ALL SELECT '<supplier_' || s_suppkey || '>', '<hasAccountBalance>', NULL, s_acctbal FROM supplier
  UNION ALL SELECT '<order_' || o_orderkey || '>', '<hasTotalPrice>', NULL, o_totalprice FROM orders
  UNION ALL SELECT '<part_' || p_partkey || '>', '<hasSize>', NULL, CAST(p_size AS DOUBLE) FROM part
  UNION ALL SELECT '<part_' || p_partkey || '>', '<hasRetailPrice>', NULL, p_retailprice FROM part
  UNION ALL SELECT '<customer_' || c_custkey || '>', '<hasName>', c_name, NULL FROM customer
),
kg_date_facts AS (
  SELECT '<order_' || o_orderkey || '>' AS subject, '<wasCreatedOnDate>' AS predicate,
         CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%m-##') ELSE strftime(o_orderdate, '%Y-%m-%d') END
           || '^^xsd:date' AS cat_object, CAST(NULL AS DOUBLE) AS num_object FROM orders
),
kg_types AS (
  SELECT subject, 'rdf:type' AS predicate, cat_object, CAST(NULL AS DOUBLE) AS num_object FROM (
    SELECT '<customer_' || c_custkey || '>' AS subject, '<wordnet_customer_100000001>' AS cat_object FROM customer
    UNION ALL SELECT '<customer_' || c_custkey || '>', '<wordnet_premium_customer_100000002>' FROM customer WHERE c_acctbal >= 5000
    UNION ALL SELECT '<customer_' || c_custkey || '>', '<wikicat_' || c_mktsegment || '>' FROM customer
    UNION ALL SELECT '<order_' || o_orderkey || '>', '<wordnet_order_100000003>' FROM orders
    UNION ALL SELECT '<order_' || o_orderkey || '>', '<wordnet_order_100000013>' FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT '<supplier_' || s_suppkey || '>', '<wordnet_supplier_100000004>' FROM supplier
    UNION ALL SELECT '<part_' || p_partkey || '>', '<wordnet_part_100000005>' FROM part
    UNION ALL SELECT '<nation_' || n_nationkey || '>', '<wordnet_country_100000006>' FROM nation
  )
),
dates AS (
  SELECT subject, predicate, strftime(try_strptime(split_part(cat_object, '^^', 1), '%Y-%m-%d'), '%Y-%m-%d') AS cat_object
  FROM kg_date_facts WHERE try_strptime(split_part(cat_object, '^^', 1), '%Y-%m-%d') IS NOT NULL
),
literals AS (
  SELECT subject, predicate, coalesce(CAST(num_object AS VARCHAR), cat_object) AS cat_object FROM kg_literal_facts
),
facts AS (
  SELECT subject, predicate, cat_object FROM kg_facts
  UNION ALL SELECT subject, predicate, cat_object FROM literals
  UNION ALL SELECT subject, predicate, cat_object FROM dates
),
sparse AS (SELECT subject, predicate, nullif(cat_object, '<4-NOT_SPECIFIED>') AS cat_object FROM facts),
wn AS (SELECT subject, cat_object AS type FROM kg_types WHERE starts_with(cat_object, '<wordnet_'))
"""

# text that CSV has to quote
AWKWARD = """' say "' || {0} || '",' || chr(10) || 'then ' || {0} || ' '"""

NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z'"

ORDER, PART = "<wordnet_order_100000003>", "<wordnet_part_100000005>"
CUSTOMER = "<wordnet_customer_100000001>"


def kg(body: str, *more: str) -> str:
    """A query over the triple views; ``more`` are further named steps."""
    return "WITH " + ",\n".join([VIEWS.strip(), *more]) + "\n" + body


def top_types(k: int, prefix: str = "", source: str = "kg_types", name: str = "top") -> str:
    return f"""{name} AS (SELECT cat_object AS type, count(*) AS count FROM {source}
      WHERE starts_with(cat_object, '{prefix}') GROUP BY 1 ORDER BY count DESC, type LIMIT {k})"""


# The first two values per type, subject and predicate, all types with the prefix.
RANKED = """ranked AS (
  SELECT type, subject, predicate, cat_object AS v,
         row_number() OVER (PARTITION BY type, subject, predicate ORDER BY cat_object NULLS LAST) AS rn
  FROM sparse JOIN wn USING (subject)),
taken AS (SELECT * FROM ranked WHERE rn <= 2)"""

# The columns of the full seed tables.
FULL_COLUMNS = f"""full_columns AS (
  SELECT type, predicate, i, '' || predicate || '_' || i AS col,
         count(v) AS n_values,
         count(*) FILTER (WHERE v IS NOT NULL AND NOT regexp_matches(v, {NUMBER})) = 0 AS is_numeric
  FROM (SELECT t.type, t.subject, t.predicate, p.i, max(CASE WHEN t.rn = p.i + 1 THEN t.v END) AS v
        FROM taken t, (VALUES (0), (1)) AS p(i) GROUP BY ALL)
  GROUP BY ALL)"""

STATS = """stats AS (
  SELECT r.type AS seed_table, r.rows, c.cols, c.n_num, c.c_num, r.size, r.rows * c.cols AS cells
  FROM (SELECT type, count(*) AS rows, CAST(sum(strlen(subject) + size) AS BIGINT) AS size
        FROM (SELECT type, subject, coalesce(sum(strlen(v)), 0) AS size FROM taken GROUP BY ALL) GROUP BY type) r
  JOIN (SELECT type, count(*) + 1 AS cols, count(*) FILTER (WHERE is_numeric) AS n_num,
               count(*) FILTER (WHERE NOT is_numeric) + 1 AS c_num FROM full_columns GROUP BY type) c
    ON r.type = c.type)"""


def names_of(seed: str) -> list[str]:
    """Predicates of a seed type, sorted."""
    return {
        ORDER: ["containsPart", "hasPriority", "hasStatus", "hasTotalPrice", "wasCreatedOnDate"],
        "<wordnet_order_100000013>": ["containsPart", "hasPriority", "hasStatus", "hasTotalPrice", "wasCreatedOnDate"],
        PART: ["hasBrand", "hasPartType", "hasRetailPrice", "hasSize"],
        CUSTOMER: ["hasAccountBalance", "hasMarketSegment", "hasName", "livesIn", "placedOrder"],
        "<wordnet_premium_customer_100000002>": ["hasAccountBalance", "hasMarketSegment", "hasName", "livesIn", "placedOrder"],
        "<wordnet_supplier_100000004>": ["hasAccountBalance", "isLocatedIn"],
        "<wordnet_country_100000006>": ["isLocatedIn"],
    }[seed]


NUMERIC = {"hasTotalPrice", "hasRetailPrice", "hasSize", "hasAccountBalance"}


def long_chain(seed: str, source: str = "taken", typed: bool = False, cols: list[str] | None = None) -> str:
    """The chain of left joins that widens one type, from the first values of each predicate."""
    cols = names_of(seed) if cols is None else cols
    select = ", ".join(
        f"CAST(j{i}.v AS DOUBLE) AS {c}" if typed and c in NUMERIC else f"j{i}.v AS {c}" for i, c in enumerate(cols)
    )
    joins = "\n".join(
        f"LEFT JOIN (SELECT subject, v FROM {source} WHERE type = '{seed}' AND predicate = '<{c}>') j{i} ON b.subject = j{i}.subject"
        for i, c in enumerate(cols)
    )
    return f"SELECT b.subject, {select} FROM (SELECT DISTINCT subject FROM {source} WHERE type = '{seed}') b\n{joins}"


def full_chain(seed: str) -> str:
    """One row per subject, two columns per predicate, as text."""
    cells = ", ".join(
        f"max(CASE WHEN predicate = '<{c}>' AND rn = {i + 1} THEN v END) AS {c}_{i}" for c in names_of(seed) for i in (0, 1)
    )
    return f"SELECT subject, {cells} FROM taken WHERE type = '{seed}' GROUP BY subject"


def full_names(seed: str) -> list[str]:
    return [f"{c}_{i}" for c in names_of(seed) for i in (0, 1)]


def capped_chain(seed: str, predicates: list[str], members: str = "", source: str = "facts") -> str:
    """Members of a type with all values of some predicates."""
    select = ", ".join(f"j{i}.cat_object AS {c}" for i, c in enumerate(predicates))
    joins = "\n".join(
        f"LEFT JOIN (SELECT subject, cat_object FROM {source} WHERE predicate = '<{c}>') j{i} ON b.subject = j{i}.subject"
        for i, c in enumerate(predicates)
    )
    return f"SELECT b.subject, {select} FROM (SELECT subject FROM kg_types WHERE cat_object = '{seed}') b\n{joins}"


def cells(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({c}, '~')" for c in columns) + ")"


SEEDS = [
    ORDER,
    "<wordnet_order_100000013>",
    PART,
    CUSTOMER,
    "<wordnet_premium_customer_100000002>",
    "<wordnet_supplier_100000004>",
    "<wordnet_country_100000006>",
]


def combination_counts(test: str) -> str:
    """Counts of all column pairs and triples of the full seed tables, one aggregate per table."""
    parts = []
    for n, seed in enumerate(SEEDS):
        names = full_names(seed)
        combos = [c for s in (2, 3) for c in combinations(names, s)]
        if not combos:
            continue
        joiner = " OR " if test == "any" else " AND "
        structs = ", ".join(
            f"{{'combination': '{'-'.join(c)}', 'count': count(*) FILTER (WHERE {joiner.join(f'{x} IS NOT NULL' for x in c)})}}"
            for c in combos
        )
        parts.append(f"SELECT '{seed}' AS seed_table, unnest([{structs}]) AS s FROM ({full_chain(seed)}) t{n}")
    return "SELECT seed_table, s.combination AS combination, s.count AS count FROM (" + " UNION ALL ".join(parts) + ") WHERE s.count >= 100"


def distinct_combinations(tables: list[tuple[str, str, list[str], str]], sizes: tuple[int, ...], least: int) -> str:
    """Rows of each combination table after the null test and de-duplication; few must be more than ``least``."""
    parts = []
    for seed, body, names, key in tables:
        for s in sizes:
            for c in combinations(names, s):
                some = " OR ".join(f"{x} IS NOT NULL" for x in c)
                parts.append(
                    f"SELECT '{seed}' AS seed_table, '{'-'.join(c)}' AS combination, "
                    f"(SELECT count(*) FROM (SELECT DISTINCT subject, {', '.join(c)} FROM {key} WHERE {some})) AS n_rows"
                )
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + f") WHERE n_rows > {least}"


def seeds_as(prefix: str, make) -> list[tuple[str, str, list[str], str]]:
    return [(s, make(s), names_of(s), f"{prefix}{i}") for i, s in enumerate(SEEDS)]


LONG_SEEDS = seeds_as("long_", lambda s: long_chain(s))

PAIRS = """one AS (SELECT DISTINCT subject, predicate FROM facts),
pairs AS (SELECT l.predicate, r.predicate AS predicate_right, count(*) AS count
          FROM one l JOIN one r USING (subject) GROUP BY ALL)"""


def raw_pairs(name: str, source: str) -> str:
    return f"""{name}_n AS (SELECT subject, predicate, count(*) AS n FROM {source} GROUP BY ALL),
{name} AS (SELECT l.predicate, r.predicate AS predicate_right, CAST(sum(l.n * r.n) AS BIGINT) AS count
           FROM {name}_n l JOIN {name}_n r USING (subject) GROUP BY ALL)"""


ADJACENT = """adjacent AS (SELECT type, predicate, count(*) AS count FROM (
  SELECT DISTINCT t.subject, t.cat_object AS type, f.predicate FROM kg_types t JOIN facts f USING (subject)) GROUP BY ALL)"""

REPRESENTATIVE = """busiest AS (SELECT subject FROM (SELECT subject, count(*) AS n FROM facts GROUP BY 1 ORDER BY n DESC, subject LIMIT 5000)),
type_n AS (SELECT cat_object AS type, count(*) AS n FROM kg_types GROUP BY 1),
chosen AS (SELECT subject, type FROM (
  SELECT t.subject, t.cat_object AS type, row_number() OVER (PARTITION BY t.subject ORDER BY n.n DESC, n.type) AS rn
  FROM kg_types t JOIN busiest USING (subject) JOIN type_n n ON n.type = t.cat_object) WHERE rn = 1),
representative AS (SELECT type, count(*) AS count FROM chosen GROUP BY 1)"""

ORDERS_WITH_GAPS = """gaps AS (
  SELECT b.subject, p.cat_object AS hasPriority, d.cat_object AS wasCreatedOnDate
  FROM (SELECT subject FROM kg_types WHERE cat_object = '<wordnet_order_100000003>') b
  LEFT JOIN (SELECT * FROM sparse WHERE predicate = '<hasPriority>') p ON b.subject = p.subject
  LEFT JOIN (SELECT * FROM dates) d ON b.subject = d.subject)"""

BY_NATION = """by_nation AS (
  SELECT c_nationkey AS Code, strftime(o_orderdate, '%Y-%m-%d') AS Start_Time,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS Severity, o_totalprice AS Visibility,
         o_orderstatus AS Category, o_orderpriority AS Level
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def mode(source: str, keys: str, column: str, name: str) -> str:
    """Most frequent value per group, the smallest among equals."""
    return f"""{name} AS (SELECT {keys}, {column} FROM (
      SELECT {keys}, {column}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS rn
      FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column}) WHERE rn = 1)"""


KNOWN = """companies AS (SELECT p_partkey, p_name AS name, p_brand, p_size,
    '<' || regexp_replace(lower(p_name), '^([^ ]*) ', '\\1_') || '>' AS formatted_name FROM part WHERE p_size >= 25),
known AS (SELECT DISTINCT '<' || replace(replace(p_name, 'red', 'Red'), ' ', '_') || '>' AS subject FROM part),
mapping AS (SELECT DISTINCT name, formatted_name, subject FROM companies JOIN known ON formatted_name = lower(subject)),
targets AS (SELECT c.name AS raw_entities, m.subject AS col_to_embed, log10(c.p_size) AS target
            FROM companies c JOIN mapping m USING (formatted_name))"""

TITLE = "array_to_string(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"

FIXED = [
    (ORDER, "status", ["hasStatus", "hasPriority"]),
    (ORDER, "dated", ["wasCreatedOnDate", "hasPriority"]),
    (ORDER, "parts", ["containsPart", "hasTotalPrice", "wasCreatedOnDate"]),
    (PART, "size", ["hasSize", "hasBrand"]),
]
SUBTABLES = " UNION ALL ".join(
    f"SELECT '{s}' AS seed_table, '{n}' AS subtable, subject, {cells(c)} AS cells_text FROM ({long_chain(s)}) "
    f"WHERE {' OR '.join(f'{x} IS NOT NULL' for x in c)}"
    for s, n, c in FIXED
)

FACTS = "SELECT subject, predicate, cat_object FROM "
TYPE_CLEAN = r"regexp_replace(regexp_replace(cat_object, '(<)([a-zA-Z_]+)[_0-9]*>', '\2', 'g'), '_+$', '')"

SIZE_ALL = """coalesce(sum(CASE WHEN rows * (1 + 2 * 0.7::DOUBLE) > 100
  THEN size / cells * (rows * (1 + 2 * 0.7::DOUBLE) * ((cols + cols - 2) / 2 * {c})) END), 0)"""
SIZE_NUM = """coalesce(sum(CASE WHEN rows * (1 + 2 * 0.7::DOUBLE) > 100 {also}
  THEN size / cells * (rows * (1 + 2 * 0.7::DOUBLE) * ((n_num + CASE WHEN n_num > 2 THEN n_num - 2 ELSE 2 END) / 2 * {c})) END), 0)"""


def base_manifest(seeds: list[str], source: str) -> str:
    parts = []
    for s in seeds:
        numeric = sum(c in NUMERIC for c in names_of(s))
        parts.append(
            f"SELECT '{s}' AS seed_table, (SELECT count(*) FROM ({capped_chain(s, names_of(s), source=source)})) AS n_rows, "
            f"CAST({len(names_of(s)) + 2} AS BIGINT) AS arity, CAST({numeric} AS BIGINT) AS n_num"
        )
    return " UNION ALL ".join(parts)


def text_cell(column: str) -> str:
    """A column as it reads after an export: numbers as such."""
    return f"CAST(CAST({column} AS DOUBLE) AS VARCHAR)" if column in NUMERIC else column


# of the seed tables of TOP_3; the combinations are called by what follows the second part
FOLDERS = ["wordnet_order", "wordnet_order_2", "wordnet_part"]
TOP_3 = [ORDER, "<wordnet_order_100000013>", PART]

RSH_9 = ["hasStatus", "hasPriority", "containsPart", "livesIn", "hasMarketSegment", "hasBrand", "hasPartType", "placedOrder"]
RSH_9_OF = {
    ORDER: ["hasStatus", "hasPriority", "containsPart"],
    "<wordnet_order_100000013>": ["hasStatus", "hasPriority", "containsPart"],
    PART: ["hasBrand", "hasPartType"],
    CUSTOMER: ["livesIn", "hasMarketSegment", "placedOrder"],
}


def rsh_9() -> str:
    parts = []
    for seed, names in RSH_9_OF.items():
        select = ", ".join(f"{c} AS {c}" if c in names else f"CAST(NULL AS VARCHAR) AS {c}" for c in RSH_9)
        parts.append(f"SELECT '{seed}' AS seed_table, subject, {select} FROM ({capped_chain(seed, names, source='kg_facts')})")
    return " UNION ALL ".join(parts)


def all_capped(source: str) -> str:
    """All types with the prefix, all their predicates, as text."""
    return " UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, subject, {cells(names_of(s))} AS cells FROM ({capped_chain(s, names_of(s), source=source)})"
        for s in SEEDS
    )


def drawn(source: str, attempts: int, smallest: int | None = None, least: int = 100, most: int | None = None) -> list[str]:
    """Named steps up to ``kept``: the specs that become subtables.

    ``source`` yields ``cols`` (seed_table, col, is_numeric) and ``patterns`` (seed_table, pattern, n).
    """
    low = "greatest(2, len(names) - 2)" if smallest is None else str(smallest)

    def digit(place: str) -> str:
        return f"""CAST('0x' || substr(md5(concat_ws('/', '42', seed_table, "case", attempt, {place})), 1, 15) AS BIGINT)"""

    past = 'OVER (PARTITION BY seed_table, "case" ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'
    open_ = "failed <= 100" if most is None else f"failed < 100 AND kept < {most}"
    return [
        source,
        """named AS (SELECT seed_table, 'all' AS "case", list(col ORDER BY col) AS names FROM cols GROUP BY 1
          UNION ALL SELECT seed_table, 'num', list(col ORDER BY col) FROM cols WHERE is_numeric GROUP BY 1 HAVING count(*) >= 2)""",
        f"tried AS (SELECT *, unnest(range(0, {attempts})) AS attempt, {low} AS low FROM named WHERE {low} <= len(names))",
        f"sized AS (SELECT *, low + {digit("'size'")} % (len(names) - low + 1) AS k FROM tried)",
        f"""picks AS (SELECT seed_table, "case", attempt, k, 0 AS i, CAST([] AS VARCHAR[]) AS cols, names AS rest FROM sized
          UNION ALL SELECT seed_table, "case", attempt, k, i + 1, list_append(cols, rest[d + 1]), list_concat(rest[1:d], rest[d + 2:])
          FROM (SELECT *, CAST({digit('i')} % len(rest) AS BIGINT) AS d FROM picks WHERE i < k))""",
        'specs AS (SELECT seed_table, "case", attempt, cols FROM picks WHERE i = k)',
        """counted AS (SELECT s.seed_table, s."case", s.attempt, s.cols, coalesce(sum(p.n), 0) AS n_rows FROM specs s
          LEFT JOIN patterns p ON p.seed_table = s.seed_table AND list_has_any(p.pattern, s.cols) GROUP BY ALL)""",
        f"""judged AS (SELECT *, n_rows > {least} AND row_number() OVER (PARTITION BY seed_table, "case", cols ORDER BY attempt) = 1 AS good FROM counted)""",
        f"""tallied AS (SELECT *, coalesce(sum(CASE WHEN good THEN 0 ELSE 1 END) {past}, 0) AS failed,
          coalesce(sum(CASE WHEN good THEN 1 ELSE 0 END) {past}, 0) AS kept FROM judged)""",
        f"""kept AS (SELECT seed_table, "case", replace(replace(array_to_string(cols, '-'), '<', ''), '>', '') AS combination,
          CAST(n_rows AS BIGINT) AS n_rows FROM tallied WHERE good AND {open_})""",
    ]


# columns and null patterns of the full seed tables with more than eight columns
FULL_LAKE = """cols AS (SELECT type AS seed_table, col, is_numeric FROM full_columns
  WHERE type IN (SELECT type FROM full_columns GROUP BY 1 HAVING count(*) + 1 > 8)),
patterns AS (SELECT seed_table, pattern, count(*) AS n FROM (
  SELECT type AS seed_table, subject, list(predicate || '_' || (rn - 1)) FILTER (WHERE v IS NOT NULL) AS pattern FROM taken GROUP BY 1, 2) GROUP BY ALL)"""
REPLICAS = """(SELECT seed_table, "case", combination, replica, CAST(CASE WHEN replica = 0 THEN n_rows ELSE floor(n_rows * 0.7::DOUBLE) END AS BIGINT) AS n_rows
  FROM kept, (VALUES (0), (1), (2)) AS r(replica))"""


def long_lake() -> str:
    """The same of the long seed tables with more than five columns."""
    wide = [s for s in SEEDS if len(names_of(s)) + 1 > 5]
    cols = " UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, '<{c}>' AS col, {'true' if c in NUMERIC else 'false'} AS is_numeric" for s in wide for c in names_of(s)
    )
    patterns = " UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, list_filter([{', '.join(f"CASE WHEN {c} IS NOT NULL THEN '<{c}>' END" for c in names_of(s))}], "
        f"lambda x: x IS NOT NULL) AS pattern, count(*) AS n FROM ({long_chain(s)}) GROUP BY ALL"
        for s in wide
    )
    return f"cols AS ({cols}),\npatterns AS ({patterns})"


def kg_drawn(body: str, *more: str) -> str:
    return kg(body, *more).replace("WITH", "WITH RECURSIVE", 1)


ENTITY_PREDICATES = ["containsPart", "hasBrand", "hasMarketSegment", "hasPartType", "hasPriority", "hasStatus", "isLocatedIn",
                     "livesIn", "placedOrder"]

ORACLE: dict[str, str] = {
    "src_1": """SELECT c_custkey AS id, c_name AS subject, c_nationkey AS predicate, c_acctbal AS cat_object,
        c_mktsegment AS num_object FROM customer WHERE c_custkey <> (SELECT max(c_custkey) FROM customer)""",
    "src_2": """SELECT c_custkey AS id, c_name AS subject, c_nationkey AS predicate, c_acctbal AS cat_object,
        c_mktsegment AS num_object FROM customer ORDER BY c_custkey LIMIT 100""",
    "src_3": kg(f"SELECT least(count(*), {SAMPLE_ROWS}) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM kg_facts"),
    "src_4": kg("SELECT '<id_' || predicate || '>' AS id, subject, predicate, cat_object FROM facts"),
    "src_5": kg(FACTS + "facts"),
    "src_6": f"SELECT * REPLACE ({AWKWARD.format('c_name')} AS c_name) FROM customer",
    "src_7": f"""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, {AWKWARD.format('p_name')} AS p_name, p_brand, p_type,
        CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
    "src_6_documents": "SELECT * FROM documents",
    "src_7_documents": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "src_8": kg("SELECT replace(replace(predicate, '<', ''), '>', '') AS predicate, subject, cat_object AS value FROM kg_facts"),
    "src_9": kg("""SELECT DISTINCT 'binary-' || replace(replace(predicate, '<', ''), '>', '') AS \"table\" FROM kg_facts"""),
    "src_10": kg("""SELECT 'wordnet_full-' || replace(replace(seed_table, '<', ''), '>', '') AS "table", cols AS arity, n_num, c_num
        FROM stats WHERE cols > 8""", RANKED, FULL_COLUMNS, STATS),
    "src_12": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", row_index, "column", value FROM
        (SELECT row_number() OVER () - 1 AS row_index, COLUMNS(*)::VARCHAR FROM (SELECT {columns} FROM {t} LIMIT 5))
        UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(* EXCLUDE (row_index))))"""
        for t, columns in [(t, "*") for t in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark",
            "labels", "conversations")]
        + [("embeddings", "* REPLACE (list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS embedding)")]
    ),
    "snk_1": kg(f"SELECT subject AS wordnet_part_100000005, * EXCLUDE (subject) FROM ({long_chain(PART, typed=True)})", RANKED),
    "snk_2": kg(f"SELECT subject AS wordnet_part_100000005, * EXCLUDE (subject) FROM ({long_chain(PART, typed=True)})", RANKED),
    "snk_4": kg(SUBTABLES, RANKED),
    "snk_5": kg("SELECT subject, cat_object AS value FROM kg_facts"),
    "norm_1": kg(FACTS + "dates"),
    "norm_2": kg(FACTS + "literals"),
    "norm_3": kg(FACTS + "kg_facts"),
    "norm_4": kg(FACTS + "facts"),
    "norm_5": kg("SELECT subject, type FROM wn"),
    "norm_6": kg("""SELECT * FROM kg_facts UNION ALL SELECT subject, predicate, cat_object, num_object FROM kg_literal_facts
        UNION ALL SELECT * FROM kg_date_facts"""),
    "fil_1": kg(FACTS + "facts WHERE subject IN (SELECT subject FROM wn WHERE type = '<wordnet_premium_customer_100000002>')"),
    "fil_2": kg(FACTS + "facts WHERE cat_object IS NOT NULL AND cat_object NOT IN (SELECT subject FROM kg_types)"),
    "fil_3": kg(FACTS + "facts WHERE predicate = '<hasStatus>'"),
    "fil_4": kg("SELECT subject, cat_object FROM kg_types WHERE contains(lower(cat_object), 'wordnet_order')"),
    "fil_5": kg(FACTS + "kg_facts WHERE NOT ends_with(cat_object, '_1>')"),
    "fil_6": kg(FACTS + """dates WHERE CAST(cat_object AS TIMESTAMP) > TIMESTAMP '1997-01-01'
        AND CAST(cat_object AS TIMESTAMP) < TIMESTAMP '1997-12-31'"""),
    "fil_7": kg("SELECT * FROM kg_literal_facts WHERE num_object >= 1000"),
    "fil_8": kg("SELECT * FROM gaps WHERE wasCreatedOnDate IS NOT NULL", ORDERS_WITH_GAPS),
    "fil_9": kg("SELECT * FROM gaps WHERE hasPriority IS NOT NULL OR wasCreatedOnDate IS NOT NULL", ORDERS_WITH_GAPS),
    "fil_10": kg("SELECT * FROM gaps WHERE hasPriority IS NOT NULL AND wasCreatedOnDate IS NOT NULL", ORDERS_WITH_GAPS),
    "prj_1": kg("SELECT cat_object AS type, subject FROM kg_types"),
    "prj_2": kg(FACTS + "kg_facts"),
    "prj_3": "SELECT p_partkey, p_size, p_retailprice FROM part",
    "prj_4": """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '[Abcdefghijk]') THEN NULL ELSE p_name END AS value_null,
        CASE WHEN p_size > 2 THEN p_size - 2 ELSE 2 END AS least FROM part""",
    "type_1": kg(f"""SELECT predicate, count(*) FILTER (WHERE cat_object IS NOT NULL AND NOT regexp_matches(cat_object, {NUMBER})) = 0
        AS is_numeric FROM facts GROUP BY 1"""),
    "join_1": kg("""SELECT t.subject, t.cat_object AS type, f.predicate, f.cat_object FROM kg_types t LEFT JOIN facts f USING (subject)
        WHERE f.predicate IS NOT NULL AND f.cat_object IS NOT NULL"""),
    "join_2": kg("""SELECT f.subject, f.predicate, f.cat_object, t.cat_object AS cat_object_right FROM facts f
        JOIN kg_types t USING (subject) JOIN top ON top.type = t.cat_object""", top_types(3, "<wordnet_")),
    "join_3": kg("SELECT type, subject FROM wn WHERE type IN (SELECT type FROM top)", top_types(2, "<wordnet_")),
    "join_4": kg(all_capped("facts")),
    "join_5": kg("SELECT subject, predicate, cat_object, type FROM facts JOIN wn USING (subject)"),
    "join_6": kg("""SELECT l.cat_object, r.cat_object AS cat_object_right, count(*) AS count FROM own l JOIN own r USING (subject)
        GROUP BY ALL""", top_types(5), "own AS (SELECT DISTINCT subject, cat_object FROM kg_types WHERE cat_object IN (SELECT type FROM top))"),
    "join_7": kg("SELECT * FROM pairs", PAIRS),
    "join_8": """SELECT c_nationkey AS Code, c_custkey, c_name, c_acctbal, c_mktsegment, n_name AS State, n_regionkey AS County
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "join_9": kg("""SELECT * FROM (SELECT *, '<nation_' || s_nationkey || '>' AS col_to_embed FROM supplier)
        WHERE col_to_embed IN (SELECT subject FROM kg_facts)"""),
    "join_10": f"""WITH {KNOWN.replace(' WHERE p_size >= 25', '')} SELECT * FROM mapping""",
    "join_11": f"WITH {KNOWN} SELECT raw_entities, col_to_embed, round(target, 9) AS target FROM targets",
    "join_12": """WITH o AS (SELECT '<customer_' || o_custkey || '>' AS col_to_embed, o_orderkey, o_orderstatus FROM orders),
        t AS (SELECT col_to_embed, o_orderstatus, log10(count(*)) AS target FROM o GROUP BY ALL)
        SELECT col_to_embed, o_orderkey, round(target, 9) AS target FROM o JOIN t USING (col_to_embed)""",
    "join_13": kg("""SELECT subject, predicate, cat_object, c_mktsegment AS party FROM facts
        JOIN customer ON subject = '<customer_' || c_custkey || '>'"""),
    "join_14": kg("""SELECT subject, predicate, cat_object, count FROM literals
        JOIN (SELECT subject, count(*) AS count FROM literals GROUP BY 1 HAVING count(*) > 1) USING (subject)"""),
    "agg_1": kg("SELECT type, predicate, count(*) AS count FROM (SELECT DISTINCT subject, type, predicate FROM wn JOIN kg_facts USING (subject)) GROUP BY ALL"),
    "agg_2": kg("SELECT type, string_agg(predicate, ',' ORDER BY predicate) AS predicates FROM adjacent GROUP BY 1", ADJACENT),
    "agg_3": kg("SELECT DISTINCT predicate FROM facts"),
    "agg_4": kg("SELECT predicate, count(*) AS count FROM facts GROUP BY 1"),
    "agg_5": kg("SELECT subject, min(cat_object) AS cat_object, count(*) AS count FROM kg_types GROUP BY 1"),
    "agg_6": kg("SELECT subject, count(*) AS count FROM facts GROUP BY 1"),
    "agg_7": kg("""SELECT predicate, count(*) AS count FROM facts WHERE subject =
        (SELECT subject FROM facts GROUP BY 1 ORDER BY count(*) DESC, subject LIMIT 1) GROUP BY 1"""),
    "agg_8": kg("""SELECT split_part(cat_object, '_', 1) AS typecat, count(DISTINCT subject) AS subject,
        count(DISTINCT cat_object) AS cat_object FROM kg_types GROUP BY split_part(cat_object, '_', 1)"""),
    "agg_9": kg("""SELECT l.cat_object AS type_left, r.cat_object AS type_right, count(*) AS count
        FROM own l JOIN own r USING (subject) GROUP BY ALL""", top_types(5),
        "own AS (SELECT subject, cat_object FROM kg_types WHERE cat_object IN (SELECT type FROM top))"),
    "agg_10": kg("SELECT * FROM raw", raw_pairs("raw", "facts")),
    "agg_11": kg("SELECT predicate_right, min(predicate) AS predicate FROM pairs GROUP BY 1", PAIRS),
    "agg_12": kg("""SELECT round(avg(n), 6) AS mean, median(n) AS median FROM (SELECT subject, count(*) AS n FROM facts
        WHERE subject IN (SELECT subject FROM kg_types WHERE cat_object IN (SELECT type FROM top)) GROUP BY 1)""", top_types(3)),
    "agg_13": "WITH " + BY_NATION + ", " + mode("by_nation", "Code, Category", "Level", "m1") + ", "
        + mode("by_nation", "Code, Category", "Start_Time", "m2")
        + """ SELECT Code, Category, round(avg(Severity), 6) AS Severity, round(avg(Visibility), 4) AS Visibility,
        any_value(m1.Level) AS Level, any_value(m2.Start_Time) AS Start_Time
        FROM by_nation LEFT JOIN m1 USING (Code, Category) LEFT JOIN m2 USING (Code, Category) GROUP BY Code, Category""",
    "agg_14": "WITH " + BY_NATION + " SELECT Code, round(log10(count(*)), 9) AS target FROM by_nation GROUP BY Code, Category",
    "agg_15": kg("SELECT cat_object AS type, subject, count(*) OVER (PARTITION BY cat_object) AS count FROM kg_types"),
    "agg_16": kg("SELECT subject, count(*) AS count FROM wn GROUP BY 1"),
    "agg_17": kg("""SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE subject IS NULL) / count(*), 6) AS subject,
        round(100.0::DOUBLE * count(*) FILTER (WHERE hasPriority IS NULL) / count(*), 6) AS hasPriority,
        round(100.0::DOUBLE * count(*) FILTER (WHERE wasCreatedOnDate IS NULL) / count(*), 6) AS wasCreatedOnDate
        FROM gaps""", ORDERS_WITH_GAPS),
    "agg_18": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS null_count,
        {f'round(avg({c}), 6)' if num else 'CAST(NULL AS DOUBLE)'} AS mean, {f'round(stddev_samp({c}), 6)' if num else 'NULL'} AS std,
        CAST(min({c}) AS VARCHAR) AS min, """
        + ", ".join(
            (f"CAST(quantile_disc({c}, {q}) AS DOUBLE)" if num else "NULL") + f" AS {n}"
            for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        + f", CAST(max({c}) AS VARCHAR) AS max FROM lineitem"
        for c, num in (("l_orderkey", True), ("l_partkey", True), ("l_suppkey", True), ("l_linenumber", True),
                       ("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True),
                       ("l_returnflag", False), ("l_linestatus", False), ("l_shipdate", False))
    ),
    "agg_19": kg("SELECT DISTINCT type AS cat_object FROM wn"),
    "agg_20": kg("SELECT count(DISTINCT type) AS n_groups FROM wn"),
    "agg_21": kg("""SELECT node, count(DISTINCT other) AS degree FROM (SELECT type AS node, predicate AS other FROM adjacent
        UNION ALL SELECT predicate, type FROM adjacent) GROUP BY 1""", ADJACENT),
    "top_1": kg("SELECT * FROM top", top_types(3, "<wordnet_")),
    "top_2": kg("""SELECT * FROM top UNION SELECT cat_object AS type, count(*) AS count FROM kg_types
        WHERE cat_object IN ('<wordnet_order_100000003>', '<wordnet_country_100000006>') GROUP BY 1""", top_types(3, "<wordnet_")),
    "top_3": kg("SELECT * FROM top", top_types(10)),
    "top_4": kg("SELECT subject FROM kg_types WHERE cat_object IN (SELECT type FROM top)", top_types(3)),
    "top_5": kg("SELECT DISTINCT subject FROM kg_types WHERE cat_object IN (SELECT type FROM top)", top_types(3)),
    "top_6": kg("SELECT * FROM top", top_types(2, "<wordnet_")),
    "top_7": kg("""SELECT subject, predicate, cat_object, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
        (PARTITION BY subject, predicate ORDER BY cat_object NULLS LAST) AS rn FROM facts) WHERE rn <= 2"""),
    "top_8": "SELECT '<customer_' || o_custkey || '>' AS col_to_embed, max(o_totalprice) AS target FROM orders GROUP BY 1",
    "ded_1": kg("SELECT DISTINCT subject, predicate, cat_object FROM facts"),
    "ded_2": kg("SELECT DISTINCT cat_object FROM kg_types"),
    "srt_1": kg("SELECT * FROM pairs ORDER BY predicate, predicate_right DESC", PAIRS),
    "win_1": kg("SELECT * FROM representative", REPRESENTATIVE),
    "win_2": kg("""SELECT f.subject, f.predicate, f.cat_object, t.cat_object AS cat_object_right FROM facts f
        JOIN kg_types t USING (subject) WHERE t.cat_object IN (SELECT type FROM representative WHERE count > 10)""", REPRESENTATIVE),
    "win_3": kg("""SELECT subject, predicate, cat_object, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
        (PARTITION BY subject, predicate ORDER BY cat_object NULLS LAST) AS rn FROM facts) WHERE rn <= 3"""),
    "win_4": kg("""SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT predicate AS label FROM facts)"""),
    "win_5": kg("""SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT cat_object AS label FROM kg_types)"""),
    "set_1": kg("""SELECT subject, type FROM wn UNION ALL SELECT subject, type FROM wn
        WHERE type IN ('<wordnet_premium_customer_100000002>', '<wordnet_country_100000006>')"""),
    "set_2": kg("SELECT DISTINCT cat_object FROM kg_literal_facts"),
    "set_3": kg("""SELECT coalesce(a.predicate, b.predicate) AS predicate, coalesce(a.predicate_right, b.predicate_right) AS predicate_right,
        CASE WHEN a.count > 0 THEN 1 ELSE 0 END - CASE WHEN b.count > 0 THEN 1 ELSE 0 END AS presence_diff,
        coalesce(a.count, 0) - coalesce(b.count, 0) AS count_diff
        FROM a FULL JOIN b ON a.predicate = b.predicate AND a.predicate_right = b.predicate_right""",
        top_types(2, "<wordnet_", name="top_a"), top_types(2, "<wordnet_c", name="top_b"),
        "facts_a AS (SELECT * FROM facts WHERE subject IN (SELECT subject FROM wn WHERE type IN (SELECT type FROM top_a)))",
        "facts_b AS (SELECT * FROM facts WHERE subject IN (SELECT subject FROM wn WHERE type IN (SELECT type FROM top_b)))",
        raw_pairs("a", "facts_a"), raw_pairs("b", "facts_b")),
    "str_1": kg(f"SELECT DISTINCT cat_object, {TYPE_CLEAN} AS clean FROM kg_types"),
    "str_2": kg(r"SELECT subject, regexp_replace(predicate, '<{1}([a-zA-Z0-9_]+)>{1}', '\1', 'g') AS clean FROM facts"),
    "str_3": kg("SELECT subject, rtrim(trim(cat_object, '<'), '>') AS clean FROM facts"),
    "str_4": kg("SELECT subject, replace(replace(cat_object, '<', ''), '>', '') AS clean FROM facts"),
    "str_5": kg("""SELECT subject, cat_object, starts_with(cat_object, '<part') AS prefix, ends_with(cat_object, '9>') AS suffix,
        contains(cat_object, '_1') AS inside, regexp_matches(cat_object, '[0-9]{3}') AS pattern FROM kg_facts"""),
    "str_6": kg("SELECT subject, split_part(cat_object, '^^', 1) AS piece FROM kg_date_facts"),
    "str_7": kg("SELECT subject, lower(cat_object) AS lowered FROM kg_types"),
    "str_8": f"SELECT p_partkey, {TITLE.format(chr(39).join(['p_name || ', '-', ' || p_type']))} AS titled FROM part",
    "str_9": r"""SELECT p_partkey, regexp_replace(n, '^([^ ]*) ', '\1_') AS first_only, replace(n, ' ', '_') AS all_of_them
        FROM (SELECT p_partkey, p_name || ' ' || p_type AS n FROM part)""",
    "str_10": r"""SELECT c_custkey, '<' || n_name || ',_' || r_name || '>' AS place,
        '<' || regexp_replace(lower(r_name), '^([^ ]*) ', '\1_') || '>' AS organisation,
        replace('<' || n_name || CASE WHEN r_name = 'AFRICA' THEN '_Parish' ELSE '_County' END || ',_' || r_name || '>', ' ', '_') AS county
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "str_11": kg(f"""SELECT cat_object, array_to_string(string_split('wordnet-' || clean, '_')[3:], '_') || '_hasSize_hasBrand' AS name
        FROM (SELECT DISTINCT cat_object, {TYPE_CLEAN} AS clean FROM kg_types)"""),
    "mth_1": "SELECT o_orderkey, round(log10(o_totalprice), 9) AS logged, round(log10(o_orderkey + 1), 9) AS logged_plus_1 FROM orders",
    "mth_2": """SELECT l_orderkey, sum(l_quantity * 2 + 1) AS a, max(l_quantity / 4 - 1) AS b,
        count(*) FILTER (WHERE l_quantity >= 25) AS c FROM lineitem GROUP BY 1""",
    "dat_1": kg("""SELECT subject, strftime(d, '%Y-%m-%d') AS day, d > DATE '1997-06-30' AS late FROM (
        SELECT subject, CAST(try_strptime(split_part(cat_object, '^^', 1), '%Y-%m-%d') AS DATE) AS d FROM kg_date_facts)"""),
    "arr_1": kg("""SELECT subject, predicate, string_agg(cat_object, ',' ORDER BY rn) AS first_two FROM (SELECT *, row_number() OVER
        (PARTITION BY subject, predicate ORDER BY cat_object) AS rn FROM kg_facts) WHERE rn <= 2 GROUP BY 1, 2"""),
    "arr_2": kg("""SELECT subject, predicate, max(CASE WHEN rn = 1 THEN cat_object END) AS value_0,
        max(CASE WHEN rn = 2 THEN cat_object END) AS value_1, max(CASE WHEN rn = 3 THEN cat_object END) AS value_2
        FROM (SELECT *, row_number() OVER (PARTITION BY subject, predicate ORDER BY cat_object) AS rn FROM kg_facts)
        GROUP BY 1, 2"""),
    "hsh_1": kg("""SELECT type, count(*) OVER (PARTITION BY predicates) AS n_same_id FROM
        (SELECT type, list(predicate ORDER BY predicate) AS predicates FROM adjacent GROUP BY type)""", ADJACENT),
    "cst_1": kg(f"""SELECT subject, predicate, cat_object, CASE WHEN regexp_matches(cat_object, {NUMBER}) THEN TRY_CAST(cat_object AS DOUBLE) END
        AS number FROM literals"""),
    "rsh_1": kg("SELECT subject, cat_object AS placedOrder FROM facts WHERE predicate = '<placedOrder>'"),
    "rsh_2": kg("SELECT type, subject FROM wn WHERE type IN (SELECT type FROM top)", top_types(3, "<wordnet_")),
    "rsh_3": kg(f"""SELECT '{CUSTOMER}' AS type, * REPLACE (CAST(hasAccountBalance AS DOUBLE) AS hasAccountBalance)
        FROM ({capped_chain(CUSTOMER, names_of(CUSTOMER))})"""),
    "rsh_3_types": kg(all_capped("sparse")),
    "rsh_3_width_4": kg(f"""SELECT '{CUSTOMER}' AS type, * REPLACE (CAST(hasAccountBalance AS DOUBLE) AS hasAccountBalance)
        FROM ({capped_chain(CUSTOMER, ["hasAccountBalance", "hasMarketSegment"])})"""),
    "rsh_4": kg(f"SELECT subject AS wordnet_order_100000003, * EXCLUDE (subject) FROM ({long_chain(ORDER, typed=True)})",
        RANKED.replace("FROM sparse", "FROM facts")),
    "rsh_4_types": kg(" UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, subject, {cells(names_of(s))} AS cells FROM ({long_chain(s)})" for s in SEEDS), RANKED),
    "rsh_4_part": kg(f"SELECT subject AS wordnet_part_100000005, * EXCLUDE (subject) FROM ({long_chain(PART, typed=True)})", RANKED),
    "rsh_5": kg(f"""SELECT subject AS wordnet_order_100000003, * EXCLUDE (subject) REPLACE (
        {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ['hasPriority_1', 'hasStatus_1', 'hasTotalPrice_0', 'hasTotalPrice_1', 'wasCreatedOnDate_1'])})
        FROM ({full_chain(ORDER)})""", RANKED),
    "rsh_5_types": kg(" UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, subject, {cells(full_names(s))} AS cells FROM ({full_chain(s)})" for s in SEEDS), RANKED),
    "rsh_6": kg("""SELECT 'binary-' || replace(replace(predicate, '<', ''), '>', '') AS "table", f.subject, f.cat_object AS value
        FROM facts f JOIN wn USING (subject) WHERE type IN (SELECT type FROM top)""", top_types(3, "<wordnet_")),
    "rsh_7": kg(f"""SELECT 'binary-' || replace(replace(predicate, '<', ''), '>', '') AS "table", subject,
        CASE WHEN is_numeric THEN TRY_CAST(cat_object AS DOUBLE) END AS number, CASE WHEN NOT is_numeric THEN cat_object END AS text
        FROM facts JOIN (SELECT predicate, count(*) FILTER (WHERE cat_object IS NOT NULL AND NOT regexp_matches(cat_object, {NUMBER})) = 0
        AS is_numeric FROM facts GROUP BY 1) USING (predicate)"""),
    "rsh_8": kg("SELECT predicate, " + ", ".join(
        f"CAST(coalesce(sum(count) FILTER (WHERE predicate_right = '<{p}>'), 0) AS BIGINT) AS {p}" for p in ENTITY_PREDICATES
    ) + " FROM raw GROUP BY 1", raw_pairs("raw", "kg_facts")),
    "rsh_9": kg(rsh_9()),
    "comb_1": kg(combination_counts("any"), RANKED),
    "comb_1_all": kg(combination_counts("all"), RANKED),
    "comb_2": kg(distinct_combinations(LONG_SEEDS, (2, 3), 10), RANKED,
        *[f"{key} AS MATERIALIZED ({body})" for _, body, _, key in LONG_SEEDS]),
    "comb_3": kg(" UNION ALL ".join(
        f"SELECT '{'-'.join(c)}' AS combination, subject, {cells(list(c))} AS cells FROM wide WHERE {c[0]} IS NOT NULL OR {c[1]} IS NOT NULL"
        for c in combinations(full_names(PART), 2) if not (c[0].endswith("_1") and c[1].endswith("_1"))
    ), RANKED, f"wide AS MATERIALIZED ({full_chain(PART)})"),
    "sub_1": kg(SUBTABLES, RANKED),
    "sub_2": kg_drawn("SELECT * FROM kept", RANKED, FULL_COLUMNS, *drawn(FULL_LAKE, 5)),
    "sub_3": kg_drawn(f"SELECT *, n_rows AS n_subjects, n_rows AS n_inside FROM {REPLICAS}", RANKED, FULL_COLUMNS, *drawn(FULL_LAKE, 5)),
    "sub_5": kg_drawn(f"SELECT * FROM {REPLICAS}", RANKED, FULL_COLUMNS, *drawn(FULL_LAKE, 5)),
    "sub_6": kg_drawn("SELECT * FROM kept", RANKED, FULL_COLUMNS, *drawn(FULL_LAKE, 110, 1, 50, 10)),
    "sub_7": kg_drawn(f"SELECT count(*) AS total_generated FROM {REPLICAS}", RANKED, FULL_COLUMNS, *drawn(FULL_LAKE, 5)),
    "sub_4": kg("""SELECT type AS seed_table, subject, string_agg(coalesce(v, '~'), '|' ORDER BY predicate, i) AS cells FROM (
          SELECT s.type, s.subject, c.predicate, c.i, t.v
          FROM (SELECT DISTINCT type, subject FROM taken) s
          JOIN (SELECT * FROM full_columns WHERE is_numeric AND type IN
                (SELECT type FROM full_columns WHERE is_numeric GROUP BY 1 HAVING count(*) >= 2)) c ON s.type = c.type
          LEFT JOIN taken t ON t.type = s.type AND t.subject = s.subject AND t.predicate = c.predicate AND t.rn = c.i + 1)
        GROUP BY 1, 2 HAVING count(v) > 0""", RANKED, FULL_COLUMNS),
    "est_1": kg("SELECT * FROM stats", RANKED, FULL_COLUMNS, STATS),
    "est_2": kg("""SELECT median(rows) AS row_median, median(cols) AS col_median, median(cells) AS cell_median,
        round(avg(rows), 6) AS row_mean, round(avg(cols), 6) AS col_mean, round(avg(cells), 6) AS cell_mean,
        list_sort(list(rows))[CAST(round(0.8 * (count(*) - 1)) AS INTEGER) + 1] AS row_qle,
        list_sort(list(cols))[CAST(round(0.8 * (count(*) - 1)) AS INTEGER) + 1] AS col_qle,
        list_sort(list(cells))[CAST(round(0.8 * (count(*) - 1)) AS INTEGER) + 1] AS cell_qle,
        count(*) AS len FROM stats WHERE cols > 8""", RANKED, FULL_COLUMNS, STATS),
    "est_3": kg(f"SELECT round({SIZE_ALL.format(c=5)}, 3) AS exp_size FROM stats", RANKED, FULL_COLUMNS, STATS),
    "est_4": kg(f"SELECT round({SIZE_NUM.format(c=5, also='')}, 3) AS exp_size FROM stats", RANKED, FULL_COLUMNS, STATS),
    "est_5": kg(f"""SELECT round({SIZE_ALL.format(c=5)} + {SIZE_NUM.format(c=5, also='AND n_num >= 2')}, 3) AS exp_size
        FROM stats WHERE cols > 8""", RANKED, FULL_COLUMNS, STATS),
    "est_6": kg(" UNION ALL ".join(
        f"""SELECT {c} AS resample_columns,
        (SELECT (count(*) + count(*) FILTER (WHERE n_num > 2)) * 3 * {c} FROM stats WHERE rows > 50 AND cols > 8) AS n_tables,
        (SELECT round({SIZE_ALL.format(c=c)} + {SIZE_NUM.format(c=c, also='AND n_num >= 2')}, 3) FROM stats WHERE cols > 8) AS exp_size"""
        for c in (1, 3, 5, 10, 30, 50, 100)
    ), RANKED, FULL_COLUMNS, STATS),
    "est_7": kg("SELECT round(avg(size / cells), 6) AS avg_size FROM stats WHERE rows > 100 AND cols > 8", RANKED, FULL_COLUMNS, STATS),
    "prp_1": kg("""SELECT County, State, col_to_embed, any_value(m1.Code) AS Code, any_value(m2.Category) AS Category,
        round(avg(Severity), 4) AS Severity, round(avg(Visibility), 4) AS Visibility, round(avg(target), 9) AS target
        FROM events e JOIN counts USING (col_to_embed) LEFT JOIN m1 USING (County, State, col_to_embed)
        LEFT JOIN m2 USING (County, State, col_to_embed) GROUP BY County, State, col_to_embed""",
        BY_NATION,
        """events AS (SELECT * FROM (SELECT b.*, '<nation_' || Code || '>' AS col_to_embed, n_name AS State, n_regionkey AS County
             FROM by_nation b JOIN nation ON Code = n_nationkey)
           WHERE col_to_embed IN (SELECT subject FROM kg_facts) AND CAST(Start_Time AS TIMESTAMP) > TIMESTAMP '1997-01-01'
             AND CAST(Start_Time AS TIMESTAMP) < TIMESTAMP '1997-12-31')""",
        "counts AS (SELECT col_to_embed, log10(count(*)) AS target FROM events GROUP BY col_to_embed, Code, Level)",
        mode("events", "County, State, col_to_embed", "Code", "m1"),
        mode("events", "County, State, col_to_embed", "Category", "m2")),
    "prp_2": f"""WITH {KNOWN} SELECT p_partkey, name, p_brand, col_to_embed, round(target, 9) AS target
        FROM companies JOIN targets ON name = raw_entities WHERE formatted_name IN (SELECT lower(subject) FROM known)""",
    "prp_3": f"""WITH r AS (SELECT {TITLE.format('n_name')} AS county_name, {TITLE.format('r_name')} AS state, c_custkey, c_mktsegment AS party
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT county_name, state, party, round(log10(c_custkey + 1), 9) AS target,
        replace('<' || county_name || CASE WHEN state = 'Africa' THEN '_Parish' ELSE '_County' END || ',_' || state || '>', ' ', '_') AS col_to_embed
        FROM r""",
    "prp_4": """SELECT '<customer_' || c_custkey || '>' AS col_to_embed, round(log10(max(o_totalprice)), 9) AS target
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "prp_5": f"""WITH {KNOWN}, own AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN p_name || ' trading' ELSE p_name END AS name FROM part WHERE p_size >= 25),
        formatted AS (SELECT name, '<' || regexp_replace(lower(name), '^([^ ]*) ', '\\1_') || '>' AS formatted_name FROM own)
        SELECT * FROM formatted WHERE formatted_name NOT IN (SELECT lower(subject) FROM known) ORDER BY name, formatted_name LIMIT 20""",
    "job_1": kg(base_manifest(TOP_3, "sparse")),
    "job_1_explode": kg(distinct_combinations(
        [(s, "", names_of(s), f"base_{i}") for i, s in enumerate(TOP_3)], (2,), 10
    ), *[f"base_{i} AS MATERIALIZED ({capped_chain(s, names_of(s), source='sparse')})" for i, s in enumerate(TOP_3)]),
    "job_1_files": kg(" UNION ALL ".join(
        f"""SELECT 'wordnet-{FOLDERS[i]}' AS folder, '{FOLDERS[i][14:]}_{a}_{b}' AS "table", '{s}' AS type, subject, {cells([text_cell(a), text_cell(b)])} AS cells
        FROM (SELECT DISTINCT subject, {a}, {b} FROM base_{i} WHERE {a} IS NOT NULL OR {b} IS NOT NULL)
        WHERE (SELECT count(*) FROM (SELECT DISTINCT subject, {a}, {b} FROM base_{i} WHERE {a} IS NOT NULL OR {b} IS NOT NULL)) > 10"""
        for i, s in enumerate(TOP_3) for a, b in combinations(names_of(s), 2)
    ), *[f"base_{i} AS MATERIALIZED ({capped_chain(s, names_of(s), source='sparse')})" for i, s in enumerate(TOP_3)]),
    "job_2": kg("""SELECT 'binary-' || replace(replace(predicate, '<', ''), '>', '') AS "table", count(*) AS n_rows
        FROM facts JOIN wn USING (subject) WHERE type IN (SELECT type FROM top) GROUP BY 1""", top_types(3, "<wordnet_")),
    "job_3": kg(" UNION ALL ".join(
        f"SELECT '{s}' AS seed_table, '{s.strip('<>')}' AS name, (SELECT count(*) FROM ({long_chain(s)})) AS n_rows, "
        f"CAST({len(names_of(s)) + 1} AS BIGINT) AS arity, CAST({sum(c in NUMERIC for c in names_of(s))} AS BIGINT) AS n_num"
        for s in SEEDS
    ), RANKED),
    "job_4": kg_drawn(f"SELECT *, n_rows AS n_written FROM {REPLICAS}", RANKED, *drawn(long_lake(), 5)),
    "job_5": kg("""SELECT type, count(*) AS n_facts, any_value(top.count) AS count FROM facts JOIN wn USING (subject)
        JOIN top USING (type) GROUP BY type""", top_types(3, "<wordnet_")),
}
