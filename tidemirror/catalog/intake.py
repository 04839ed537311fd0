"""Lead intake over events as requests, and the rate limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemirror.catalog.registry import query, table
from tidemirror.operators import intake as V
from tidemirror.operators.ratelimit import rate_limit

LIMIT = 3
WINDOW_SECONDS = 86_400


def requests(spark, sf):
    """Events as form posts; the kind of event decides how well-formed the post is."""
    slug = (
        F.when(F.col("value") < 5, "")
        .when(F.col("value") < 10, "nosuch")
        .when(F.col("value") < 20, "furniture")
        .when(F.col("value") < 40, "building")
        .otherwise("household")
    )
    good = F.format_string(
        '"nombre":"User %s","email":"user%s@example.com","telefono":"%s"',
        F.col("user_id").cast("string"),
        F.col("user_id").cast("string"),
        (F.col("event_id") + 1_000_000).cast("string"),
    )
    bad = F.lit('"nombre":"x","email":"not-an-email","telefono":1234567')
    fields = (
        F.when(F.col("event_type") == "signup", bad)
        .when(F.col("event_type") == "view", F.concat(good, F.lit(',"hp_field":"bot"')))
        .when(F.col("event_type") == "purchase", F.concat(good, F.lit(',"hp_field":"","extra":true')))
        .otherwise(good)
    )
    post = F.concat(F.lit('{"landing_slug":"'), slug, F.lit('",'), fields, F.lit("}"))
    broken = F.when(F.col("value") < 20, "not json{").otherwise('"just text"')
    body = F.when(F.col("event_type") == "error", broken).otherwise(post)
    return table(spark, sf, "events").select("event_id", "user_id", "ts", body.alias("body"))


def campaigns(spark, sf):
    """Market segments as campaigns; one has no list yet."""
    ready = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey"))
    found = table(spark, sf, "customer").groupBy(F.lower("c_mktsegment").alias("slug")).agg(F.max(ready).alias("list_id"))
    return found.withColumn("success_url", F.concat(F.lit("/"), "slug", F.lit("/gracias")))


_SLUG = """
    CASE WHEN event_type = 'error' OR value < 5 THEN NULL WHEN value < 10 THEN 'nosuch' WHEN value < 20 THEN 'furniture'
         WHEN value < 40 THEN 'building' ELSE 'household' END
"""

_CAMPAIGNS = """
    SELECT lower(c_mktsegment) AS slug, max(CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey END) AS list_id
    FROM customer GROUP BY 1
"""

ALLOWED = f"""
    WITH RECURSIVE w AS (
        SELECT user_id, min(ts) AS opened FROM events GROUP BY user_id
        UNION ALL
        SELECT w.user_id, min(e.ts) FROM w JOIN events e
            ON e.user_id = w.user_id AND e.ts >= w.opened + INTERVAL {WINDOW_SECONDS} SECOND
        GROUP BY w.user_id),
    placed AS (SELECT e.*, w.opened FROM events e ASOF JOIN w ON e.user_id = w.user_id AND e.ts >= w.opened),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, opened ORDER BY ts, event_id) AS n FROM placed)
    SELECT event_id, user_id, ts, event_type, value, n <= {LIMIT} AS allowed, greatest({LIMIT} - n, 0) AS remaining FROM ranked
"""


@query(f"SELECT event_id, user_id, ts, allowed, remaining FROM ({ALLOWED})")
def rate_limit_batch(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return rate_limit(events, "user_id", "ts", "event_id", limit=LIMIT, window_seconds=WINDOW_SECONDS)


@query("""
    WITH RECURSIVE w AS (
        SELECT min(ts) AS opened FROM events
        UNION ALL
        SELECT * FROM (SELECT (SELECT min(ts) FROM events WHERE ts >= w.opened + INTERVAL 60 SECOND) AS opened FROM w)
        WHERE opened IS NOT NULL),
    placed AS (SELECT event_id, ts, opened FROM events e ASOF JOIN w ON e.ts >= w.opened)
    SELECT event_id, n <= 1 AS allowed, 0 AS remaining
    FROM (SELECT *, row_number() OVER (PARTITION BY opened ORDER BY ts, event_id) AS n FROM placed)
""")
def rate_limit_hot_key(spark, sf):
    """Every event under one key, one a minute."""
    events = table(spark, sf, "events").select("event_id", "ts", F.lit("all").alias("client"))
    return rate_limit(events, "client", "ts", "event_id", limit=1, window_seconds=60).drop("ts", "client")


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'unknown' ELSE '10.0.0.' || user_id END AS client FROM events
""")
def client_key(spark, sf):
    """The rate limit's key, from a forwarding header with one or two addresses or none."""
    address = F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))
    header = F.when(F.col("event_type") == "click", F.concat(F.lit(" "), address, F.lit(" , 172.16.0.1")))
    header = header.when(F.col("event_type") != "error", address)
    return table(spark, sf, "events").select("event_id", V.client_key(header).alias("client"))


@query("SELECT event_id, event_type = 'view' AS is_bot FROM events")
def bot_filter(spark, sf):
    posts = requests(spark, sf)
    return posts.select("event_id", V.is_bot(V.text_field(V.payload(F.col("body")), V.TRAP_FIELD)).alias("is_bot"))


@query("""
    SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'Nombre requerido' END AS nombre_error,
           CASE WHEN event_type IN ('error', 'signup') THEN 'Email inválido' END AS email_error,
           CASE WHEN event_type IN ('error', 'signup') THEN 'Teléfono requerido' END AS telefono_error,
           CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '{"nombre":"x","email":"not-an-email"}'
                ELSE '{"nombre":"User ' || user_id || '","email":"user' || user_id || '@example.com","telefono":"'
                     || (event_id + 1000000) || '"}' END AS data
    FROM events
""")
def validate_payload(spark, sf):
    value = V.payload(F.col("body"))
    posts = requests(spark, sf).select("event_id", value.alias("value"))
    errors = V.validation_errors(F.col("value"))
    told = posts.select("event_id", "value", errors.alias("errors"))
    return told.select(
        "event_id",
        *[F.col("errors")[rule.name].alias(f"{rule.name}_error") for rule in V.LEAD_RULES],
        F.when(F.col("value").isNotNull() & (F.schema_of_variant("value") != "STRING"), F.to_json(V.known_fields(F.col("value")))).alias("data"),
    )


@query(f"""
    WITH c AS ({_CAMPAIGNS}), r AS (SELECT event_id, {_SLUG} AS slug FROM events)
    SELECT event_id, r.slug, c.slug AS campaign, list_id, '/' || c.slug || '/gracias' AS success_url
    FROM r LEFT JOIN c ON c.slug = r.slug
""")
def campaign_lookup(spark, sf):
    slug = F.nullif(V.text_field(V.payload(F.col("body")), V.SLUG_FIELD), F.lit(""))
    posts = requests(spark, sf).select("event_id", slug.alias("slug"))
    return V.find_campaign(posts, campaigns(spark, sf))


@query(f"""
    WITH a AS ({ALLOWED}), c AS ({_CAMPAIGNS}), r AS (SELECT *, {_SLUG} AS slug FROM a)
    SELECT event_id,
           CASE WHEN NOT allowed THEN 'rate_limited'
                WHEN event_type = 'error' AND value < 20 THEN 'invalid_json'
                WHEN event_type = 'error' THEN 'invalid_body'
                WHEN r.slug IS NULL THEN 'missing_landing_slug'
                WHEN c.slug IS NULL THEN 'unknown_landing'
                WHEN event_type = 'view' THEN 'bot'
                WHEN event_type = 'signup' THEN 'invalid'
                WHEN list_id IS NULL THEN 'landing_not_ready' ELSE 'ok' END AS outcome
    FROM r LEFT JOIN c ON c.slug = r.slug
""")
def classify_outcome(spark, sf):
    posts = rate_limit(requests(spark, sf), "user_id", "ts", "event_id", limit=LIMIT, window_seconds=WINDOW_SECONDS)
    parsed = posts.select("event_id", "allowed", V.payload(F.col("body")).alias("value"))
    found = V.find_campaign(parsed.withColumn("slug", V.text_field(F.col("value"), V.SLUG_FIELD)), campaigns(spark, sf))
    told = V.outcome(F.col("value"), F.col("allowed"), F.col("campaign"), F.col("list_id"))
    return found.select("event_id", told.alias("outcome"))


@query(f"""
    WITH c AS ({_CAMPAIGNS}), r AS (SELECT ts, user_id AS contact_id, {_SLUG} AS slug FROM events)
    SELECT DISTINCT list_id, contact_id FROM r JOIN c ON c.slug = r.slug WHERE list_id IS NOT NULL
""")
def list_membership_add(spark, sf):
    """Members of the first half of the month, joined by those since the tenth."""
    slug = V.text_field(V.payload(F.col("body")), V.SLUG_FIELD)
    found = V.find_campaign(requests(spark, sf).withColumn("slug", slug), campaigns(spark, sf))
    wanted = found.filter("list_id is not null").select("list_id", F.col("user_id").alias("contact_id"), "ts")
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    members = wanted.filter(F.col("ts") < day("2024-01-15")).select("list_id", "contact_id").distinct()
    return V.add_to_list(members, wanted.filter(F.col("ts") >= day("2024-01-10")))
