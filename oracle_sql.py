"""DuckDB oracle for the named queries.

Each statement computes, straight from the parquet tables, what the Spark
query computes from the JSON / CSV lines the test adapter renders. The
adapter's rules are repeated here in SQL (see ``rateflow/sources/tables.py``).
Integers are BIGINT and doubles are rounded to 6 places, like
``rateflow.plans.queries.canonical``.
"""

from __future__ import annotations

# Fixed values shared with the adapter.
SPLIT_DATE = "2000-01-01"
LISTED_MAX_SIZE = 47
AS_OF = "2025-01-01"
HEADER = "user_id,business_id,stars"
USER_COUNTER_MODULI = {
    "review_count": 50, "useful": 97, "funny": 31, "cool": 37,
    "compliment_cool": 29, "compliment_funny": 41, "compliment_list": 3,
    "compliment_note": 23, "compliment_more": 5, "compliment_photos": 17,
    "compliment_profile": 7, "compliment_writer": 13, "compliment_cute": 9,
    "compliment_plain": 19, "compliment_hot": 11,
}
USER_COUNTERS = [
    "review_count", "fans", "useful", "average_stars", "funny", "cool",
    "compliment_cool", "compliment_funny", "compliment_list", "compliment_note",
    "compliment_more", "compliment_photos", "compliment_profile", "compliment_writer",
    "compliment_cute", "compliment_plain", "compliment_hot",
]
FEATURES_29 = [
    "user_avg_rating", "users_review_count", "useful", "funny", "cool",
    "business_avg_rating", "reviews", "is_open", "avg_noise", "has_WiFi",
    "checkins", "photo", "avg_user_business_like", "business_score", "fans",
    "avg_friends", "compliment_cool", "compliment_funny", "compliment_list",
    "compliment_note", "compliment_more", "compliment_photo", "compliment_profile",
    "compliment_writer", "user_yelping_age", "business_open", "business_price",
    "avg_weekend_days", "business_attr",
]
FEATURES_32 = (
    FEATURES_29[:24] + ["compliment_cute", "compliment_plain", "compliment_hot"] + FEATURES_29[24:]
)
FEATURES_15 = [
    "user_avg_rating", "users_review_count", "business_avg_rating", "reviews", "is_open",
    "avg_noise", "has_WiFi", "checkins", "photo", "avg_user_business_like",
    "business_score", "business_open", "business_price", "avg_weekend_days", "business_attr",
]
EARLIER = {
    "v8": [
        "user_avg_rating", "users_review_count", "useful", "funny", "cool",
        "business_avg_rating", "reviews", "is_open",
    ],
    "v9": [
        "user_avg_rating", "users_review_count", "business_avg_rating", "reviews",
        "avg_noise", "has_WiFi", "checkins", "photo", "avg_user_business_like",
    ],
    "v10": [
        "user_avg_rating", "users_review_count", "useful", "fans", "business_avg_rating",
        "reviews", "photo", "checkins", "funny", "cool",
    ],
}
STUMP_FEATURES = ["is_open", "avg_noise", "has_WiFi", "business_price", "avg_weekend_days"]
MIN_LEAF = 20
STUMP_PAIRS = [(1, 1), (2, 1), (3, 1), (5, 1), (8, 1)]
NODE_ROUNDS = 4
LEARNING_RATE = 0.1
PAGE = 50
LOOKUPS = {
    "user_avg_rating": "u_average_stars", "users_review_count": "u_review_count",
    "useful": "u_useful", "funny": "u_funny", "cool": "u_cool",
    "business_avg_rating": "b_stars", "reviews": "b_review_count", "is_open": "b_is_open",
    "avg_noise": "b_noise", "has_WiFi": "b_wifi", "checkins": "b_checkins", "photo": "b_photo",
    "avg_user_business_like": "t_likes", "business_score": "b_rivals", "fans": "u_fans",
    "avg_friends": "u_friends", "compliment_cool": "u_compliment_cool",
    "compliment_funny": "u_compliment_funny", "compliment_list": "u_compliment_list",
    "compliment_note": "u_compliment_note", "compliment_more": "u_compliment_more",
    "compliment_photo": "u_compliment_photos", "compliment_profile": "u_compliment_profile",
    "compliment_writer": "u_compliment_writer", "compliment_cute": "u_compliment_cute",
    "compliment_plain": "u_compliment_plain", "compliment_hot": "u_compliment_hot",
    "user_yelping_age": "u_age", "business_open": "b_open_days", "business_price": "b_price",
    "avg_weekend_days": "b_weekend", "business_attr": "b_attr",
}


def r6(expr: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0
    return f"(ROUND(CAST({expr} AS DOUBLE), 6) + 0.0)"


def i64(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# --- the adapter's inputs, as relations ------------------------------------

def _base(parity: bool = False, gaps: bool = False) -> str:
    wifi = "0" if parity else "p_size % 3"
    friends = (
        "CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE 1 END"
        if parity
        else "CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE c_nationkey % 5 + 1 END"
    )
    counters = ",\n    ".join(f"(b % {m} + {m}) % {m} AS {n}" for n, m in USER_COUNTER_MODULI.items())
    # With gaps, some keys have no line: the lookups then fall back on the defaults.
    parts = f"WHERE p_size <= {LISTED_MAX_SIZE}" if gaps else ""
    customers = "WHERE c_acctbal >= 0" if gaps else ""
    photographed = "WHERE l_returnflag = 'R'" if gaps else ""
    return f"""
rated AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(l.l_partkey AS VARCHAR) AS business_id,
         CAST(1 + CAST(l.l_quantity AS BIGINT) % 5 AS DOUBLE) AS stars,
         l.l_linenumber,
         o.o_orderdate < TIMESTAMP '{SPLIT_DATE}' AS is_train
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
train AS (SELECT user_id, business_id, stars AS rating, stars AS label FROM rated WHERE is_train),
val AS (SELECT user_id, business_id, stars AS rating, stars AS label FROM rated WHERE NOT is_train),
biz AS (
  SELECT CAST(p_partkey AS VARCHAR) AS business_id,
         p_brand AS postal_code,
         CAST(1 + (p_partkey % 9) * 0.5 AS DOUBLE) AS stars,
         (p_size * 7) % 20 AS review_count,
         CASE WHEN p_size % 11 = 0 THEN 0 WHEN p_size % 3 > 0 THEN 1 ELSE 0 END AS is_open,
         CASE WHEN p_size % 7 <> 0 AND p_size % 2 = 0 THEN 1 ELSE 0 END
           + CASE WHEN p_size % 6 = 0 THEN 0 ELSE len(string_split(p_name, ' ')) END AS attr_score,
         CASE WHEN p_size % 7 = 0 THEN 0 ELSE {wifi} END AS wifi,
         CASE WHEN p_size % 7 = 0 THEN 3
              WHEN p_type = 'ECONOMY' THEN 1 WHEN p_type = 'PROMO' THEN 4
              WHEN p_type = 'LARGE' THEN 5 ELSE 3 END AS noise,
         CASE WHEN p_size % 7 = 0 THEN -1 ELSE p_size % 4 + 1 END AS price,
         CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size % 7 + 1 END AS open_days,
         CASE WHEN p_size % 5 = 0 THEN 2
              ELSE 1 + CASE WHEN p_size % 7 + 1 >= 6 THEN 1 ELSE 0 END
                     + CASE WHEN p_size % 7 + 1 >= 7 THEN 1 ELSE 0 END END AS weekend
  FROM part {parts}
),
photos AS (
  SELECT CAST(l_partkey AS VARCHAR) AS business_id, count(*) AS photos
  FROM lineitem {photographed} GROUP BY 1
),
checkins AS (SELECT CAST(l_partkey AS VARCHAR) AS business_id, count(*) AS checkins FROM lineitem GROUP BY 1),
rivals AS (SELECT postal_code, count(DISTINCT business_id) AS rivals FROM biz GROUP BY 1),
tips AS (SELECT user_id, business_id, sum(l_linenumber % 3) AS t_likes FROM rated GROUP BY 1, 2),
usr AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id,
    CASE WHEN f.first_order IS NULL THEN 0.0
         ELSE date_diff('day', CAST(f.first_order AS DATE), DATE '{AS_OF}') / 365.0 END AS age,
    {friends} AS friends,
    b % 50 <> 0 AND c_nationkey % 6 <> 5 AS has_counters,
    c_nationkey AS fans,
    CAST(100 + (b % 400 + 400) % 400 AS DOUBLE) / 100.0 AS average_stars,
    {counters}
  FROM (SELECT *, CAST(floor(c_acctbal) AS BIGINT) AS b FROM customer {customers}) c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) f
    ON c.c_custkey = f.o_custkey
),
bdim AS (
  SELECT k.business_id, b.postal_code,
         b.stars AS b_stars,
         CASE WHEN b.review_count <> 0 THEN b.review_count END AS b_review_count,
         b.is_open AS b_is_open, b.attr_score AS b_attr, b.wifi AS b_wifi, b.noise AS b_noise,
         b.price AS b_price, b.open_days AS b_open_days, b.weekend AS b_weekend,
         ph.photos AS b_photo, ck.checkins AS b_checkins, rv.rivals AS b_rivals
  FROM (SELECT business_id FROM biz UNION SELECT business_id FROM photos
        UNION SELECT business_id FROM checkins) k
  LEFT JOIN biz b ON b.business_id = k.business_id
  LEFT JOIN photos ph ON ph.business_id = k.business_id
  LEFT JOIN checkins ck ON ck.business_id = k.business_id
  LEFT JOIN rivals rv ON rv.postal_code = {"k.business_id" if parity else "b.postal_code"}
),
udim AS (
  SELECT user_id, age AS u_age, friends AS u_friends, has_counters AS u_has_counters,
    {", ".join(f"CASE WHEN has_counters THEN {n} END AS u_{n}" for n in USER_COUNTERS)}
  FROM usr
),
bmeans AS (
  SELECT avg(b_stars) AS mean_stars, avg(b_review_count) AS mean_review_count_b,
         avg(b_attr) AS mean_attr,
         (SELECT avg(open_days) FROM biz) AS mean_open_days_lines,
         avg(CASE WHEN b_open_days = 0 THEN (SELECT avg(open_days) FROM biz) ELSE b_open_days END)
           AS mean_open_days,
         avg(b_wifi) AS mean_wifi, avg(b_noise) AS mean_noise, avg(b_weekend) AS mean_weekend,
         avg(b_price) AS mean_price, avg(b_checkins) AS mean_checkins, avg(b_photo) AS mean_photo
  FROM bdim
),
umeans AS (
  SELECT {", ".join(f"avg(u_{n}) AS mean_{n}" for n in USER_COUNTERS if n != "review_count")},
         avg(u_review_count) AS mean_review_count_u,
         avg(u_age) AS mean_age, avg(u_friends) AS mean_friends
  FROM udim
),
tmean AS (SELECT avg(t_likes) AS mean_likes FROM tips),
rmean AS (SELECT {"2.0 AS mean_rivals" if parity else "avg(rivals) AS mean_rivals FROM rivals"}),
dflt AS (
  SELECT {_defaults_sql(parity)}, mean_open_days_lines AS d_open_days_lines
  FROM bmeans, umeans, tmean, rmean
)"""


def _defaults_sql(parity: bool) -> str:
    d = {
        "user_avg_rating": "mean_average_stars", "users_review_count": "mean_review_count_u",
        "useful": "mean_useful", "funny": "mean_funny", "cool": "mean_cool",
        "business_avg_rating": "mean_stars", "reviews": "mean_review_count_b", "is_open": "1.0",
        "avg_noise": "mean_noise", "has_WiFi": "mean_wifi", "checkins": "mean_checkins",
        "photo": "mean_photo", "avg_user_business_like": "mean_likes",
        "business_score": "mean_rivals", "fans": "mean_fans", "avg_friends": "mean_friends",
        "compliment_cool": "mean_compliment_cool", "compliment_funny": "mean_compliment_funny",
        "compliment_list": "mean_compliment_list", "compliment_note": "mean_compliment_note",
        "compliment_more": "mean_compliment_more", "compliment_photo": "mean_compliment_photos",
        "compliment_profile": "mean_compliment_profile",
        "compliment_writer": "mean_compliment_writer", "compliment_cute": "mean_compliment_cute",
        "compliment_plain": "mean_compliment_plain", "compliment_hot": "mean_compliment_hot",
        "user_yelping_age": "mean_age", "business_open": "mean_open_days",
        "business_price": "mean_price", "avg_weekend_days": "mean_weekend",
        "business_attr": "mean_attr",
    }
    if parity:
        d["user_avg_rating"], d["business_avg_rating"] = d["business_avg_rating"], d["user_avg_rating"]
        d["compliment_cool"] = "mean_cool"
        d["compliment_funny"] = "mean_compliment_cool"
        d["compliment_list"] = "mean_compliment_funny"
    return ", ".join(f"CAST({v} AS DOUBLE) AS d_{k}" for k, v in d.items())


def _with(body: str, parity: bool = False, gaps: bool = False) -> str:
    return f"WITH {_base(parity, gaps)}\n{body}"


def _feature_expr(name: str) -> str:
    value = f"CAST({LOOKUPS[name]} AS DOUBLE)"
    if name == "business_open":
        value = f"CASE WHEN {value} = 0 THEN d_open_days_lines ELSE {value} END"
    return f"COALESCE({value}, d_{name})"


def _matrix_cte(features: list[str], source: str = "train") -> str:
    cols = ",\n    ".join(f"{_feature_expr(f)} AS {f}" for f in features)
    return f"""
m_{source} AS (
  SELECT t.user_id, t.business_id, t.rating, t.label,
    {cols}
  FROM {source} t
  LEFT JOIN bdim b ON b.business_id = t.business_id
  LEFT JOIN udim u ON u.user_id = t.user_id
  LEFT JOIN tips tp ON tp.user_id = t.user_id AND tp.business_id = t.business_id
  CROSS JOIN dflt
)"""


def _matrix(features: list[str], parity: bool = False) -> str:
    cols = ", ".join(f"{r6(f)} AS {f}" for f in features)
    return _with(
        f""", {_matrix_cte(features)}
SELECT user_id, business_id, {r6('rating')} AS rating, {r6('label')} AS label, {cols}
FROM m_train""",
        parity,
        gaps=True,
    )


def _standardized(source: str, stats_source: str, parity: bool = False) -> str:
    feats = FEATURES_29
    ctes = _matrix_cte(feats, "train")
    if source != "train":
        ctes += "," + _matrix_cte(feats, source)
    stats = ", ".join(
        f"avg({f}) AS {f}__mean, stddev_pop({f}) AS {f}__sd" for f in feats
    )
    cols = ", ".join(
        f"{r6(f'({f} - {f}__mean) / CASE WHEN {f}__sd = 0 THEN 1.0 ELSE {f}__sd END')} AS {f}"
        for f in feats
    )
    return _with(
        f""", {ctes},
st AS (SELECT {stats} FROM m_{stats_source})
SELECT user_id, business_id, {r6('rating')} AS rating, {r6('label')} AS label, {cols}
FROM m_{source} CROSS JOIN st""",
        parity,
        gaps=True,
    )


def _business_feature(col: str, expr: str | None = None, where: str = "") -> str:
    return _with(f"SELECT business_id, {expr or col} AS {col} FROM biz {where}")


def _stump() -> str:
    """A regression stump: of all midpoints between neighbouring values, the split of least squared error.

    Each side keeps MIN_LEAF rows and predicts its mean label.
    """
    values = "\nUNION ALL\n".join(f"SELECT {i} AS f, CAST({n} AS DOUBLE) AS v, label FROM m_train" for i, n in enumerate(STUMP_FEATURES))
    chosen = "CASE f " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(STUMP_FEATURES)) + " END"
    return _with(
        f""", {_matrix_cte(STUMP_FEATURES)}, {_matrix_cte(STUMP_FEATURES, "val")},
sides AS (
  SELECT f, v, lead(v) OVER w AS next_v, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
         sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
  FROM (SELECT f, v, count(*) AS n, sum(label) AS s FROM ({values}) GROUP BY f, v)
  WINDOW w AS (PARTITION BY f ORDER BY v)
),
best AS (
  SELECT f, (v + next_v) / 2 AS cut, sl / nl AS mean_left, (s - sl) / (n - nl) AS mean_right
  FROM sides WHERE next_v IS NOT NULL AND nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF}
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1
)
SELECT user_id, business_id, {r6('label')} AS label,
       {r6(f'CASE WHEN {chosen} <= cut THEN mean_left ELSE mean_right END')} AS prediction
FROM m_val CROSS JOIN best""",
        gaps=True,
    )


def _rounds(rounds: int, rows: str) -> str:
    """Boosted stumps on ``rows``, one relation per round: ``best_k`` (the split) and ``g_k`` (groups of equal features, prediction so far).

    The first stump is fitted to the labels and counts in full, later ones to twice
    what is missing and count by the learning rate.
    """
    names = ", ".join(STUMP_FEATURES)
    chosen = "CASE f " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(STUMP_FEATURES)) + " END"
    ctes = [f"g_0 AS (SELECT {names}, count(*) AS n, sum(label) AS s, CAST(0 AS DOUBLE) AS p FROM {rows} GROUP BY {names})"]
    for k in range(1, rounds + 1):
        target = "s" if k == 1 else "2 * (s - n * p)"
        values = " UNION ALL ".join(f"SELECT {i} AS f, CAST({c} AS DOUBLE) AS v, n, {target} AS s FROM g_{k - 1}" for i, c in enumerate(STUMP_FEATURES))
        weight = 1.0 if k == 1 else LEARNING_RATE
        ctes.append(f"""
best_{k} AS (
  SELECT {k} AS round, f, (v + next_v) / 2 AS cut, s / n AS mean_all, sl / nl AS mean_left, (s - sl) / (n - nl) AS mean_right, CAST({weight} AS DOUBLE) AS weight
  FROM (
    SELECT f, v, lead(v) OVER w AS next_v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
    FROM (SELECT f, v, sum(n) AS n, sum(s) AS s FROM ({values}) GROUP BY f, v) WINDOW w AS (PARTITION BY f ORDER BY v)
  )
  WHERE next_v IS NOT NULL AND nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF}
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, f, cut LIMIT 1
),
g_{k} AS (SELECT {names}, n, s, p + weight * CASE WHEN {chosen} <= cut THEN mean_left ELSE mean_right END AS p FROM g_{k - 1} CROSS JOIN best_{k})""")
    return ",".join(ctes)


def _stump_search() -> str:
    most = max(r for r, _ in STUMP_PAIRS)
    chosen = "CASE f " + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(STUMP_FEATURES)) + " END"
    splits = " UNION ALL ".join(f"SELECT * FROM best_{k}" for k in range(1, most + 1))
    tried = " UNION ALL ".join(f"""
SELECT CAST({rounds} AS BIGINT) AS rounds, CAST({depth} AS BIGINT) AS depth, sqrt(avg((p - label) * (p - label))) AS rmse
FROM (SELECT label, sum(weight * CASE WHEN {chosen} <= cut THEN mean_left ELSE mean_right END) AS p
      FROM tested CROSS JOIN splits WHERE round <= {rounds} GROUP BY row_no, label)""" for rounds, depth in STUMP_PAIRS)
    return _with(
        f""", {_matrix_cte(STUMP_FEATURES)},
dealt AS (SELECT *, CAST('0x' || substr(md5(user_id || '|' || business_id || '|39'), 1, 8) AS BIGINT) % 5 = 0 AS held_out FROM m_train),
grown AS (SELECT * FROM dealt WHERE NOT held_out),
tested AS (SELECT *, row_number() OVER () AS row_no FROM dealt WHERE held_out),
{_rounds(most, "grown")},
splits AS ({splits}),
tried AS ({tried})
SELECT rounds, depth, {r6('rmse')} AS rmse, (rounds, depth) = (SELECT (rounds, depth) FROM tried ORDER BY rmse, rounds LIMIT 1) AS best FROM tried""",
        gaps=True,
    )


def _stump_nodes() -> str:
    named = "CASE f " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(STUMP_FEATURES)) + " END"
    rows = []
    for k in range(1, NODE_ROUNDS + 1):
        for node, value in ((0, "mean_all"), (1, "mean_left"), (2, "mean_right")):
            root = node == 0
            rows.append(
                f"SELECT CAST({k - 1} AS BIGINT) AS tree, CAST({node} AS BIGINT) AS node, {named if root else 'NULL'} AS feature, "
                f"{r6('cut') if root else 'NULL'} AS threshold, CAST({1 if root else 'NULL'} AS BIGINT) AS left, CAST({2 if root else 'NULL'} AS BIGINT) AS right, "
                f"{r6(value)} AS value, {r6('weight')} AS weight FROM best_{k}"
            )
    return _with(f", {_matrix_cte(STUMP_FEATURES)}, {_rounds(NODE_ROUNDS, 'm_train')}\n" + "\nUNION ALL\n".join(rows), gaps=True)


MEAN_PRED = "(SELECT avg(label) FROM train)"


def _error_hist(pred_rel: str) -> str:
    rows = []
    buckets = [(0, 1), (1, 2), (2, 3), (3, 4), (4, None)]
    for i, (lo, hi) in enumerate(buckets):
        cond = f"e >= {lo}" + ("" if hi is None else f" AND e < {hi}")
        hi_sql = "CAST(NULL AS BIGINT)" if hi is None else str(hi)
        rows.append(
            f"SELECT CAST({i} AS BIGINT) AS bucket, CAST({lo} AS BIGINT) AS lo, "
            f"CAST({hi_sql} AS BIGINT) AS hi, CAST(count_if({cond}) AS BIGINT) AS n FROM err"
        )
    return f", err AS (SELECT abs(prediction - label) AS e FROM {pred_rel})\n" + "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    counters_p15 = ", ".join(
        (f"{r6(n)} AS {n}" if n == "average_stars" else f"{i64(n)} AS {n}") for n in USER_COUNTERS
    )
    q: dict[str, str] = {}
    # sources and sinks
    q["src_text_lines"] = _with(
        f"""SELECT '{HEADER}' AS value
UNION ALL
SELECT user_id || ',' || business_id || ',' || CAST(stars AS VARCHAR) FROM rated WHERE is_train"""
    )
    q["src_json_parse"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS business_id, p_brand AS postal_code,
       CAST(CAST(1 + (p_partkey % 9) * 0.5 AS DOUBLE) AS VARCHAR) AS stars,
       CAST((p_size * 7) % 20 AS VARCHAR) AS review_count,
       CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 3 > 0 THEN '1' ELSE '0' END AS is_open,
       CASE WHEN p_size % 6 = 0 THEN NULL ELSE replace(p_name, ' ', ', ') END AS categories,
       CAST(CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_type = 'SMALL' THEN 3 ELSE 4 END AS BIGINT)
         AS n_attributes,
       p_size % 5 <> 0 AS has_hours
FROM part"""
    q["src_csv_ratings"] = _with(
        f"SELECT user_id, business_id, {r6('rating')} AS rating, {r6('label')} AS label, "
        "CAST(3 AS BIGINT) AS n_fields FROM train"
    )
    q["val_frame"] = _with(f"SELECT user_id, business_id, {r6('rating')} AS original_rating FROM val")
    q["sink_predictions"] = _with(f"SELECT user_id, business_id, {r6(MEAN_PRED)} AS prediction FROM val")
    q["preview_limit"] = _with(
        "SELECT postal_code, CAST(rivals AS BIGINT) AS rivals FROM rivals ORDER BY postal_code LIMIT 10"
    )
    last = "SELECT user_id, business_id, CAST(t_likes AS BIGINT) AS t_likes FROM tips ORDER BY user_id DESC, business_id DESC LIMIT 1"
    q["preview_last_pair"] = _with(last)
    q["preview_fifth_last_pair"] = _with(f"{last} OFFSET 4")
    read = """FROM (
  SELECT l_orderkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS business_id,
         CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS stars, o_orderdate < TIMESTAMP '{date}' AS is_train
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
) WHERE {which} ORDER BY l_orderkey DESC, l_linenumber DESC, user_id DESC, business_id DESC, stars DESC LIMIT 1"""
    q["preview_last"] = f"SELECT user_id, business_id, {r6('stars')} AS original_rating " + read.format(date=SPLIT_DATE, which="NOT is_train")
    q["preview_fifth_last"] = f"SELECT business_id, user_id, {r6('stars')} AS stars " + read.format(date=SPLIT_DATE, which="is_train") + " OFFSET 4"
    damage = """SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS postal_code, CASE p_partkey % 10 WHEN 3 THEN 'malformed' WHEN 5 THEN 'blank' WHEN 7 THEN 'no key business_id' END AS reason FROM part"""
    q["src_json_quarantine"] = f"""
SELECT CASE WHEN reason IS NULL THEN id END AS business_id, CASE WHEN reason IS NULL THEN postal_code END AS postal_code, reason,
       CASE reason WHEN 'malformed' THEN '{{"business_id":"' || id || '"' WHEN 'blank' THEN '  ' WHEN 'no key business_id' THEN '{{"name":"' || id || '"}}' END AS line
FROM ({damage})"""
    q["src_json_quarantine_counts"] = (
        f"SELECT CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS n_kept, CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS n_rejected FROM ({damage})"
    )
    q["preview_key"] = _with(f"SELECT business_id, {r6('stars')} AS stars FROM biz WHERE business_id = '1'")
    # per-line features
    q["checkin_total"] = _with("SELECT business_id, CAST(checkins AS BIGINT) AS checkins FROM checkins")
    q["review_projection"] = _with(f"SELECT business_id, user_id, {r6('rating')} AS stars FROM train")
    q["business_is_open"] = _business_feature("is_open", i64("is_open"))
    q["business_attr_score"] = _business_feature("attr_score", i64("attr_score"))
    q["business_stars"] = _business_feature("stars", r6("stars"))
    q["business_wifi"] = _business_feature("wifi", i64("wifi"))
    q["business_open_days"] = _business_feature("open_days", i64("open_days"))
    q["business_weekend_days"] = _business_feature("weekend_days", i64("weekend"))
    q["business_noise"] = _business_feature("noise", i64("noise"))
    q["business_price_range"] = _business_feature("price", i64("price"))
    q["business_review_count"] = _business_feature(
        "review_count", i64("review_count"), "WHERE review_count <> 0"
    )
    q["open_days_imputed"] = _with(
        "SELECT business_id, "
        + r6("CASE WHEN open_days = 0 THEN (SELECT avg(open_days) FROM biz) ELSE open_days END")
        + " AS open_days FROM biz"
    )
    q["user_account_age"] = _with(f"SELECT user_id, {r6('age')} AS age FROM usr")
    q["user_friend_count"] = _with(f"SELECT user_id, {i64('friends')} AS friends FROM usr")
    q["user_features"] = _with(f"SELECT user_id, {counters_p15} FROM usr WHERE has_counters")
    q["tip_likes"] = _with(f"SELECT user_id, business_id, {i64('t_likes')} AS t_likes FROM tips")
    q["label_column"] = _with(f"SELECT user_id, business_id, {r6('label')} AS label FROM train")
    # joins
    bcols = ["b_stars", "b_review_count", "b_is_open", "b_noise", "b_wifi", "b_checkins",
             "b_photo", "b_rivals", "b_open_days", "b_price", "b_weekend", "b_attr"]
    q["join_business"] = _with(
        f"SELECT t.user_id, t.business_id, {r6('t.label')} AS label, "
        + ", ".join(f"{r6(c) if c == 'b_stars' else i64(c)} AS {c}" for c in bcols)
        + " FROM train t LEFT JOIN bdim b ON b.business_id = t.business_id",
        gaps=True,
    )
    ucols = {"u_age": "d", "u_friends": "i", "u_average_stars": "d", "u_review_count": "i",
             "u_fans": "i", "u_useful": "i", "u_compliment_hot": "i"}
    q["join_user"] = _with(
        f"SELECT t.user_id, t.business_id, {r6('t.label')} AS label, "
        + ", ".join(f"{r6(c) if k == 'd' else i64(c)} AS {c}" for c, k in ucols.items())
        + " FROM train t LEFT JOIN udim u ON u.user_id = t.user_id",
        gaps=True,
    )
    q["join_tip"] = _with(
        f"SELECT t.user_id, t.business_id, {r6('t.label')} AS label, {i64('tp.t_likes')} AS t_likes "
        "FROM train t LEFT JOIN tips tp ON tp.user_id = t.user_id AND tp.business_id = t.business_id",
        gaps=True,
    )
    q["join_rivals"] = _with(f"SELECT business_id, postal_code, {i64('b_rivals')} AS b_rivals FROM bdim", gaps=True)
    dcols = [f"d_{f}" for f in FEATURES_32] + ["d_open_days_lines"]
    q["fill_defaults"] = _with("SELECT " + ", ".join(f"{r6(c)} AS {c}" for c in dcols) + " FROM dflt", gaps=True)
    # aggregates
    q["photo_count"] = _with(f"SELECT business_id, {i64('photos')} AS photos FROM photos")
    q["rivals_per_area"] = _with(f"SELECT postal_code, {i64('rivals')} AS rivals FROM rivals")
    q["rating_var_business"] = _with(
        f"SELECT business_id, {r6('var_pop(rating)')} AS rating_var FROM train GROUP BY 1"
    )
    q["rating_var_user"] = _with(
        f"SELECT user_id, {r6('var_pop(rating)')} AS rating_var FROM train GROUP BY 1"
    )
    q["feature_domain"] = _with(
        "SELECT DISTINCT 'noise' AS feature, CAST(noise AS BIGINT) AS value FROM biz "
        "UNION SELECT DISTINCT 'price', CAST(price AS BIGINT) FROM biz"
    )
    q["user_means"] = _with(
        "SELECT "
        + ", ".join(f"{r6(f'avg(u_{n})')} AS mean_{n}" for n in USER_COUNTERS)
        + f", {r6('avg(u_age)')} AS mean_age, {r6('avg(u_friends)')} AS mean_friends FROM udim"
    )
    q["business_means"] = _with(
        "SELECT "
        + ", ".join(
            f"{r6(c)} AS {a}"
            for c, a in [
                ("mean_stars", "mean_stars"), ("mean_review_count_b", "mean_review_count"),
                ("mean_attr", "mean_attr"), ("mean_open_days_lines", "mean_open_days_lines"),
                ("mean_open_days", "mean_open_days"), ("mean_wifi", "mean_wifi"),
                ("mean_noise", "mean_noise"), ("mean_weekend", "mean_weekend"),
                ("mean_price", "mean_price"), ("mean_checkins", "mean_checkins"),
                ("mean_photo", "mean_photo"),
            ]
        )
        + " FROM bmeans"
    )
    q["tip_mean"] = _with(f"SELECT {r6('mean_likes')} AS mean_likes FROM tmean")
    q["variance_means"] = _with(
        f"""SELECT {r6('(SELECT avg(v) FROM (SELECT var_pop(rating) AS v FROM train GROUP BY user_id))')}
         AS mean_user_var,
       {r6('(SELECT avg(v) FROM (SELECT var_pop(rating) AS v FROM train GROUP BY business_id))')}
         AS mean_business_var"""
    )
    q["rivals_mean"] = _with(f"SELECT {r6('mean_rivals')} AS mean_rivals FROM rmean")
    q["eval_rmse"] = _with(
        f"SELECT {r6(f'sqrt(avg(({MEAN_PRED} - label) * ({MEAN_PRED} - label)))')} AS rmse, "
        "CAST(count(*) AS BIGINT) AS n FROM val"
    )
    q["eval_error_hist"] = _with(
        f", pred AS (SELECT label, {MEAN_PRED} AS prediction FROM val)" + _error_hist("pred")
    )
    q["rating_mean_group"] = _with(
        f"SELECT business_id, {r6('avg(rating)')} AS rating_mean FROM train GROUP BY 1"
    )
    q["review_count_user"] = _with("SELECT user_id, CAST(count(*) AS BIGINT) AS reviews FROM train GROUP BY 1")
    q["user_rating_list"] = _with(f"SELECT user_id, business_id, {r6('rating')} AS rating FROM train")
    q["user_rating_pages"] = _with(
        f""", placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY encode(business_id), rating) - 1 AS place FROM train)
SELECT user_id, CAST(place // {PAGE} AS BIGINT) AS page, CAST(count(*) AS BIGINT) AS n, string_agg(business_id, ',' ORDER BY place) AS businesses,
       string_agg(CAST(rating AS VARCHAR), ',' ORDER BY place) AS stars
FROM placed GROUP BY 1, 2"""
    )
    # features and scaling
    q["feature_matrix"] = _matrix(FEATURES_29)
    q["feature_matrix_bucketed"] = _matrix(FEATURES_29)
    q["feature_matrix_v32"] = _matrix(FEATURES_32)
    q["feature_matrix_v15"] = _matrix(FEATURES_15)
    for name, features in EARLIER.items():
        q[f"feature_matrix_{name}"] = _matrix(features)
    q["feature_matrix_parity"] = _matrix(FEATURES_29, parity=True)
    q["standardize"] = _standardized("train", "train")
    q["standardize_val"] = _standardized("val", "train")
    q["standardize_val_parity"] = _standardized("val", "val", parity=True)
    # model
    q["gbt_stump"] = _stump()
    q["gbt_check"] = _with(
        "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_null, "
        f"(SELECT {r6('stddev_pop(label)')} FROM train) AS mean_rmse, true AS not_above_mean FROM val",
        gaps=True,
    )
    q["gbt_search_small"] = _stump_search()
    q["gbt_nodes"] = _stump_nodes()
    # collaborative filtering
    q["user_index"] = _with(
        "SELECT user_id, CAST(row_number() OVER (ORDER BY encode(user_id)) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT user_id FROM train)"
    )
    q["als_origins"] = _with(
        f""", pair AS (SELECT user_id, business_id, avg(label) AS label FROM train GROUP BY 1, 2),
um AS (SELECT user_id, avg(label) AS m FROM pair GROUP BY 1),
bm AS (SELECT business_id, avg(label) AS m FROM pair GROUP BY 1)
SELECT v.user_id, v.business_id, {r6('v.label')} AS label,
       CASE WHEN um.m IS NOT NULL AND bm.m IS NOT NULL THEN 'factors' WHEN um.m IS NOT NULL THEN 'user'
            WHEN bm.m IS NOT NULL THEN 'business' ELSE 'mean' END AS origin,
       CASE WHEN um.m IS NULL OR bm.m IS NULL THEN {r6('coalesce(um.m, bm.m, (SELECT avg(label) FROM pair))')} END AS mean_prediction
FROM val v LEFT JOIN um USING (user_id) LEFT JOIN bm USING (business_id)"""
    )
    return q
