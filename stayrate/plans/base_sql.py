"""Named sub-queries that the check SQL builds on, in DuckDB's dialect."""

SUBSCRIBERS = """
subscribers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerID,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    CAST(tenure AS INTEGER) AS tenure,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No' ELSE 'Yes' END AS PhoneService,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'No phone service'
         WHEN urg % 2 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE WHEN c_custkey % 9 < 4 THEN 'Fiber optic' WHEN c_custkey % 9 < 7 THEN 'DSL' ELSE 'No' END AS InternetService,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN r % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN a % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN n % 2 = 0 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN op % 2 = 0 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN q % 2 = 0 THEN 'Yes' ELSE 'No' END AS StreamingTV,
    CASE WHEN c_custkey % 9 >= 7 THEN 'No internet service' WHEN t % 2 = 0 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE WHEN n_orders % 11 < 6 THEN 'Month-to-month' WHEN n_orders % 11 < 8 THEN 'One year' ELSE 'Two year' END AS Contract,
    CASE WHEN fin % 2 = 0 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
    CAST(mc AS DOUBLE) AS MonthlyCharges,
    CASE WHEN tenure = 0 THEN ' ' ELSE CAST(CAST(mc * tenure AS DECIMAL(10,2)) AS VARCHAR) END AS TotalCharges,
    CASE WHEN gap > 300 THEN 'Yes' ELSE 'No' END AS Churn
  FROM (
    SELECT c.*, o.n_orders, o.urg, o.fin,
      coalesce(li.r, 0) AS r, coalesce(li.a, 0) AS a, coalesce(li.n, 0) AS n,
      coalesce(li.op, 0) AS op, coalesce(li.q, 0) AS q, coalesce(li.t, 0) AS t,
      date_diff('day', CAST(o.f AS DATE), CAST(o.l AS DATE)) % 73 AS tenure,
      date_diff('day', CAST(o.l AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS gap,
      CAST((1825 + abs(CAST(round(c.c_acctbal * 100) AS BIGINT)) % 10051) / 100.0 AS DECIMAL(10,2)) AS mc
    FROM customer c
    JOIN (SELECT o_custkey, count(*) AS n_orders,
            count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urg,
            count(*) FILTER (WHERE o_orderstatus = 'F') AS fin,
            min(o_orderdate) AS f, max(o_orderdate) AS l
          FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
    LEFT JOIN (SELECT o_custkey,
            count(*) FILTER (WHERE l_returnflag = 'R') AS r,
            count(*) FILTER (WHERE l_returnflag = 'A') AS a,
            count(*) FILTER (WHERE l_returnflag = 'N') AS n,
            count(*) FILTER (WHERE l_linestatus = 'O') AS op,
            count(*) FILTER (WHERE l_quantity > 25) AS q,
            count(*) FILTER (WHERE l_tax > 0.04) AS t
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey) li
      ON c.c_custkey = li.o_custkey))
"""

CLEAN = """
clean AS (
  SELECT * REPLACE (TRY_CAST(trim(TotalCharges) AS DOUBLE) AS TotalCharges)
  FROM subscribers WHERE TRY_CAST(trim(TotalCharges) AS DOUBLE) IS NOT NULL)
"""

# Rule score, 0..1, with its truth label; see operators.scoring.
SCORED = """
scored AS (
  SELECT customerID, Contract, y, points / 10.0::DOUBLE AS score, CASE WHEN points >= 5 THEN 1 ELSE 0 END AS yhat
  FROM (SELECT customerID, Contract, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS y,
      least(10, 2 * (Contract = 'Month-to-month')::INT + 2 * (tenure < 12)::INT
        + (InternetService = 'Fiber optic')::INT + (OnlineSecurity = 'No')::INT + (TechSupport = 'No')::INT
        + (PaperlessBilling = 'Yes')::INT + (PaymentMethod LIKE '%Electronic%')::INT
        + (MonthlyCharges > 70)::INT) AS points
    FROM subscribers))
"""

ORDERED = [("subscribers", SUBSCRIBERS), ("clean", CLEAN), ("scored", SCORED)]


def with_base(sql: str) -> str:
    """Put the sub-queries that ``sql`` needs in front of it."""
    needed = [text.strip() for name, text in ORDERED if name in sql or name == "subscribers"]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(needed) + ",\n" + body[5:]
    return "WITH " + ",\n".join(needed) + "\n" + body

# Fragments used by many checks.
TOTAL = "count(*)"
CHURNED = "count(*) FILTER (WHERE Churn = 'Yes')"
RETAINED = "count(*) FILTER (WHERE Churn = 'No')"


def rate(digits: int = 2) -> str:
    return f"round(count(*) FILTER (WHERE Churn = 'Yes') * 100.0 / count(*), {digits})"


def money(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(column: str, digits: int = 2) -> str:
    return f"round({money(column)} / count({column}), {digits})"


def bucket_case(edges, labels, column="tenure", op="<=", rest=None, lowest=None, include_lowest=False) -> str:
    parts = []
    if lowest is not None:
        parts.append(f"WHEN {column} {'<' if include_lowest else '<='} {lowest} THEN NULL")
    parts += [f"WHEN {column} {op} {e} THEN '{t}'" for e, t in zip(edges, labels, strict=True)]
    tail = f" ELSE '{rest}'" if rest else ""
    return "CASE " + " ".join(parts) + tail + " END"
