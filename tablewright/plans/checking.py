"""Queries: text jobs, JSON contracts, state sequences, HTML values."""

from pyspark.sql import functions as F

from tablewright.operators import contracts as ct
from tablewright.operators import text_jobs as tj
from tablewright.plans.registry import query


@query("""
WITH texts AS (SELECT CAST(p_size AS VARCHAR) AS age FROM part UNION ALL SELECT lang FROM documents
  UNION ALL SELECT CAST(p_size + 20 AS VARCHAR) FROM part UNION ALL SELECT CAST(-p_size AS VARCHAR) FROM part),
 n AS (SELECT TRY_CAST(age AS DOUBLE) AS a FROM texts)
SELECT CASE WHEN a IS NULL THEN 'not a number' WHEN a >= 0 AND a < 18 THEN '0-17' WHEN a >= 18 AND a < 60 THEN '18-59'
  WHEN a > 60 THEN 'over 60' ELSE 'other' END AS band, count(*) AS rows FROM n GROUP BY 1
""")
def age_band_counts(t):
    three = F.array(F.col("p_size"), F.col("p_size") + 20, -F.col("p_size"))
    sizes = t.part.select(F.explode(three.cast("array<string>")).alias("age"))
    return tj.age_band_counts(sizes.unionByName(t.documents.select(F.col("lang").alias("age"))), "age")


@query("""
SELECT lang, CAST(sum(length(regexp_replace(lower(text), '[^eyuioa]', '', 'g'))) AS BIGINT) AS vowels,
  CAST(sum(length(regexp_replace(lower(text), '[^qwrtpsdfghjklzxcvbnm]', '', 'g'))) AS BIGINT) AS consonants
FROM documents GROUP BY lang
""")
def letter_structure(t):
    return tj.letter_structure(t.documents, "text", "lang")


@query(r"""
WITH words AS (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents)
SELECT word, count(*) AS rows FROM words WHERE word <> '' AND word = reverse(word) GROUP BY word
""")
def palindrome_words(t):
    return tj.palindrome_words(t.documents, "text")


# response bodies of five kinds, one per event type: good, broken, without fields, with NULL, with blank
BODY = """
CASE event_type WHEN 'purchase' THEN props WHEN 'error' THEN substr(props, 1, length(props) - 1)
  WHEN 'click' THEN '{}' WHEN 'view' THEN '{"k": null}' ELSE '{"k": ""}' END"""


@query(f"""
WITH r AS (SELECT {BODY} AS body, value FROM events),
 p AS (SELECT value, json_valid(body) AS ok, CASE WHEN json_valid(body) THEN body END AS body FROM r),
 v AS (SELECT ok, value, json_extract_string(body, '$.k') AS k, list_contains(json_keys(body), 'k') AS has FROM p),
 c AS (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS is_json, count(*) FILTER (WHERE has) AS has_fields,
   count(k) AS not_null, count(*) FILTER (WHERE k <> '') AS not_empty, count(*) FILTER (WHERE k = '69') AS equals_k,
   count(*) FILTER (WHERE value < 50) AS fast FROM v)
SELECT rule, passed, n - passed AS failed FROM (UNPIVOT c ON is_json, has_fields, not_null, not_empty, equals_k, fast
  INTO NAME rule VALUE passed)
""")
def json_contract_report(t):
    bodies = t.events.select(F.expr(BODY).alias("body"), "value")
    rules = ct.contract_rules("body", ["k"], {"k": "69"}, elapsed=F.col("value"), limit=50)
    return ct.json_contract_report(bodies, rules)


# records of five kinds: good, empty array, numbers for texts, a missing name, broken text
RECORD = """
CASE event_type WHEN 'purchase' THEN '{"name":"a","tags":["x","y"],"k":' || user_id || '}'
  WHEN 'view' THEN '{"name":"a","tags":[],"k":' || user_id || '}'
  WHEN 'click' THEN '{"name":7,"tags":[1,2],"k":"x"}'
  WHEN 'error' THEN '{"tags":["x"],"k":' || user_id || '}' ELSE '{"name"' END"""


@query(f"""
WITH r AS (SELECT event_id, {RECORD} AS body FROM events),
 p AS (SELECT event_id, json_valid(body) AS ok, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS body FROM r)
SELECT event_id, CASE WHEN NOT ok THEN 'not an object' ELSE concat_ws(',',
  CASE WHEN json_type(body, '$.name') IS DISTINCT FROM 'VARCHAR' THEN 'name' END,
  CASE WHEN json_type(body, '$.tags') IS DISTINCT FROM 'ARRAY' OR list_contains(json_type(body, '$.tags[*]'), 'UBIGINT') THEN 'tags' END,
  CASE WHEN json_type(body, '$.k') IS DISTINCT FROM 'UBIGINT' THEN 'k' END) END AS problems
FROM p
""")
def json_schema_check(t):
    records = t.events.select("event_id", F.expr(RECORD).alias("body"))
    checked = ct.json_schema_check(records, "body", {"name": "string", "tags": "array<string>", "k": "bigint"})
    return checked.select("event_id", F.array_join("problems", ",").alias("problems"))


# the same document in other spacing, in another order, or with one field more
LAYOUT = """
CASE event_type WHEN 'purchase' THEN '{"v":true,' || substr(props, 2) WHEN 'view' THEN substr(props, 1, length(props) - 1) || ' ,  "v" : true }'
  WHEN 'click' THEN '{"v":true,"w":1,' || substr(props, 2) WHEN 'error' THEN props ELSE 'none' END"""


@query("""
SELECT event_id, event_type IN ('purchase', 'view') AND props = '{"k": 69}' AS same FROM events
""")
def json_exact_body(t):
    bodies = t.events.select("event_id", F.expr(LAYOUT).alias("body"))
    return ct.json_exact_body(bodies, "body", {"k": 69, "v": True}).select("event_id", "same")


ALLOWED = ((None, "signup"), ("signup", "view"), ("view", "click"), ("view", "view"), ("click", "purchase"), ("purchase", "view"))


@query("""
WITH s AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, count(*) AS steps, count(*) FILTER (WHERE coalesce(before, '') || '>' || event_type NOT IN
  ('>signup', 'signup>view', 'view>click', 'view>view', 'click>purchase', 'purchase>view')) AS violations
FROM s GROUP BY user_id
""")
def status_flow_audit(t):
    return ct.status_flow_audit(t.events, "user_id", ["ts", "event_id"], "event_type", ALLOWED)


@query("""
WITH RECURSIVE moves(a, b) AS (VALUES ('', 'signup'), ('signup', 'view'), ('view', 'click'), ('view', 'view'), ('click', 'purchase'), ('purchase', 'view')),
 steps AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
 walk AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS pos, '' AS now, false AS wrong FROM events
  UNION ALL
  SELECT w.user_id, w.pos + 1, coalesce(m.b, w.now), m.b IS NULL
  FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.pos = w.pos + 1 LEFT JOIN moves m ON m.a = w.now AND m.b = s.event_type)
SELECT user_id, max(pos) AS steps, count(*) FILTER (WHERE wrong) AS violations, nullif(arg_max(now, pos), '') AS reached FROM walk GROUP BY user_id
""")
def status_flow_machine(t):
    return ct.status_flow_machine(t.events, "user_id", ["ts", "event_id"], "event_type", ALLOWED)


# another way than the library's: comments and scripts cut out, the rest split at every tag, names and values at the quotes
TAGS = r"""
pieces AS (SELECT page_id, list_filter(string_split(regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '', 'g'), '<'),
    lambda p: regexp_matches(p, '^TAG[ >]')) AS tags FROM pages),
each AS (SELECT page_id, split_part(unnest(tags), '>', 1) AS tag, CAST(generate_subscripts(tags, 1) - 1 AS INTEGER) AS position FROM pieces)"""


@query(f"""
WITH {TAGS.replace('TAG', 'a')}
SELECT page_id, position, split_part(split_part(tag, ' href="', 2), '"', 1) AS value FROM each WHERE contains(tag, ' href="')
""")
def html_attr_extract(t):
    return ct.html_attr_extract(t.pages, "html", "a", "href", ["page_id"])


@query(f"""
WITH {TAGS.replace('TAG', 'html')}
SELECT page_id, position, split_part(split_part(tag, ' lang="', 2), '"', 1) AS value FROM each WHERE contains(tag, ' lang="en"')
""")
def html_attr_extract_match(t):
    """The form that narrows to tags with a given attribute value: here the language of English pages."""
    return ct.html_attr_extract(t.pages, "html", "html", "lang", ["page_id"], match=("lang", "en"))
