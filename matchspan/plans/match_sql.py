"""Independent SQL statement of the match-range semantics, used as the DuckDB
oracle.  It follows the specification literally -- distinct-value set sizes,
one ``lead`` per direction over the full key, first end by order, neighbour
flags for the merge -- and shares no code with the Spark operator.
"""

from __future__ import annotations

from ..config import EndReason

# The status naming and the derivation of match_events.
MATCH_EVENTS_SQL = """
SELECT user_id AS a,
       CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN user_id + 1 ELSE user_id END AS b,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'start'
            WHEN event_type IN ('view', 'click') THEN 'update'
            WHEN event_type = 'error' THEN 'end' END AS status,
       date_trunc('hour', ts) AS t,
       CASE WHEN k % 7 = 0 THEN NULL ELSE user_id % 3 END AS o1,
       CASE WHEN k % 11 = 0 THEN k END AS o2
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
"""

# The same log with every third user folded into key 0 (one hot key).
HOT_MATCH_EVENTS_SQL = MATCH_EVENTS_SQL.replace(
    "FROM events) e",
    "FROM (SELECT * REPLACE (CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)) e")

# The same log with every third user's events under key 0 and in one hour of their year.
TIED_MATCH_EVENTS_SQL = f"""
SELECT CASE WHEN a % 3 = 0 THEN 0 ELSE a END AS a, b, status,
       CASE WHEN a % 3 = 0 THEN date_trunc('year', t) ELSE t END AS t, o1, o2
FROM ({MATCH_EVENTS_SQL}) m"""

_REASON_CASE = "CASE {o} " + " ".join(f"WHEN {r.value} THEN '{r.name}'" for r in EndReason) + " END "


def _recode(policy: str, filters: list[str]) -> str:
    where = ["a IS NOT NULL AND t IS NOT NULL", "(a IS NOT NULL OR b IS NOT NULL)"]
    order = (["ignore_updates"] if policy == "ignore" else []) + filters
    for f in order:
        where.append({
            "ignore_updates": "status IN (1, 3)",
            "null_a": "a IS NOT NULL",
            "null_b_on_start": "(b IS NOT NULL OR status <> 1)",
        }[f])
    status = "CASE WHEN status = 2 THEN 1 ELSE status END" if policy == "assume_start" else "status"
    return f"""
rec AS (
  SELECT a, b, CAST(CASE status WHEN 'start' THEN 1 WHEN 'update' THEN 2 WHEN 'end' THEN 3 END AS INTEGER) AS status,
         t, o1, o2
  FROM me),
init AS (
  SELECT a, b, CAST({status} AS INTEGER) AS status, t, o1, o2
  FROM rec WHERE {' AND '.join(where)})"""


def _pass(src: str, name: str, key: list[str], match: list[str]) -> str:
    """One validation pass, one CTE per match column so the flag is re-read."""
    part = ", ".join(key)
    sets = ", ".join(
        f"count(DISTINCT {c}) OVER (PARTITION BY {part}) AS n_{c}, min({c}) OVER (PARTITION BY {part}) AS one_{c}"
        for c in match
    )
    ctes = [f"{name}_s AS (SELECT *, {sets} FROM {src})"]
    prev = f"{name}_s"
    cols = ["a", "b", "status", "t", "o1", "o2", "v"]
    for i, c in enumerate(match):
        cur = f"{name}_{i}"
        vexpr = f"CASE WHEN status = 1 AND v AND n_{c} > 1 THEN false ELSE v END"
        ctes.append(f"{cur}_v AS (SELECT * REPLACE ({vexpr} AS v) FROM {prev})")
        cexpr = f"CASE WHEN status = 1 AND v AND n_{c} = 1 THEN one_{c} ELSE {c} END"
        ctes.append(f"{cur} AS (SELECT * REPLACE ({cexpr} AS {c}) FROM {cur}_v)")
        prev = cur
    ctes.append(f"{name} AS (SELECT DISTINCT {', '.join(cols)} FROM {prev})")
    return ",\n".join(ctes)


def _direction(src: str, name: str, k: str, c: str, reasons: list[int]) -> str:
    w = (f"PARTITION BY {k} ORDER BY t ASC, status DESC NULLS LAST, {c} ASC NULLS LAST, "
         "o1 ASC NULLS LAST, o2 ASC NULLS LAST")
    allowed = ", ".join(str(r) for r in reasons)
    return f"""
{name}_l AS (
  SELECT *, lead({k}) OVER w AS nk_{name}, lead({c}) OVER w AS nc_{name},
         lead(status) OVER w AS ns_{name}, lead(t) OVER w AS nt_{name}
  FROM {src} WINDOW w AS ({w})),
{name} AS (
  SELECT * EXCLUDE (nk_{name}, nc_{name}, ns_{name}),
    CASE WHEN status = 1 AND v AND nk_{name} = {k} THEN
      (CASE WHEN ns_{name} = 3 AND nc_{name} = {c} AND 1 IN ({allowed}) THEN 1
            WHEN ns_{name} = 3 AND nc_{name} <> {c} AND 2 IN ({allowed}) THEN 2
            WHEN ns_{name} = 3 AND nc_{name} IS NULL AND 3 IN ({allowed}) THEN 3
            WHEN ns_{name} = 1 AND nc_{name} <> {c} AND 4 IN ({allowed}) THEN 4
            WHEN ns_{name} = 1 AND nc_{name} = {c} AND 5 IN ({allowed}) THEN 5
            WHEN ns_{name} = 1 AND nc_{name} IS NULL AND 6 IN ({allowed}) THEN 6 END)
    END AS r_{name}
  FROM {name}_l)"""


def match_sql(policy: str, filters: list[str], reasons: list[int] | None = None, upto: str = "merged",
              events_sql: str = MATCH_EVENTS_SQL) -> str:
    """SQL for one configuration of the analysis over ``match_events``.

    ``upto`` selects the stage returned: init, p1, valid, cands, final, merged.
    """
    reasons = reasons or [r.value for r in EndReason]
    parts = [f"me AS ({events_sql})", _recode(policy, filters).strip()]
    parts.append("v0 AS (SELECT *, COALESCE(status = 1 AND a IS NOT NULL AND b IS NOT NULL, false) AS v FROM init)")
    parts.append(_pass("v0", "p1", ["a", "t"], ["o1", "o2", "b"]))
    parts.append(_pass("p1", "p2", ["b", "t"], ["o1", "o2", "a"]))
    parts.append(_direction("p2", "da", "a", "b", reasons).strip())
    parts.append(_direction("da", "db", "b", "a", reasons).strip())
    parts.append("""
cands AS (
  SELECT a, b, status, t, o1, o2, v, CASE WHEN status = 1 THEN t END AS start_time,
         r_da AS end_reason_ordinal, nt_da AS end_time FROM db WHERE r_da IS NOT NULL
  UNION
  SELECT a, b, status, t, o1, o2, v, CASE WHEN status = 1 THEN t END AS start_time,
         r_db AS end_reason_ordinal, nt_db AS end_time FROM db WHERE r_db IS NOT NULL
  UNION
  SELECT a, b, status, t, o1, o2, v, CASE WHEN status = 1 THEN t END AS start_time,
         NULL, NULL FROM db WHERE r_da IS NULL AND r_db IS NULL),
fin_w AS (
  SELECT *, first_value(end_time) OVER w AS fe, first_value(end_reason_ordinal) OVER w AS fo
  FROM cands WHERE end_time IS NOT NULL
  WINDOW w AS (PARTITION BY a, b, start_time ORDER BY end_time, end_reason_ordinal)),
fin AS (
  SELECT DISTINCT a, b, status, t, o1, o2, v, start_time, fe AS final_end_time,
         """ + _REASON_CASE.format(o="fo") + """ AS final_end_reason
  FROM fin_w WHERE end_time = fe),
nb AS (
  SELECT *, CASE WHEN up AND low THEN 3 WHEN up THEN 1 WHEN low THEN 2 ELSE 0 END AS ns
  FROM (SELECT *, COALESCE(lead(start_time) OVER w = final_end_time, false) AS up,
               COALESCE(lag(final_end_time) OVER w = start_time, false) AS low
        FROM fin WINDOW w AS (PARTITION BY a, b ORDER BY start_time))),
nb2 AS (
  SELECT * REPLACE (
      CASE WHEN ns = 1 THEN lead(final_end_time) OVER w ELSE final_end_time END AS final_end_time,
      CASE WHEN ns = 1 THEN lead(final_end_reason) OVER w ELSE final_end_reason END AS final_end_reason)
  FROM nb WHERE ns IN (0, 1, 2) WINDOW w AS (PARTITION BY a, b ORDER BY start_time)),
merged AS (
  SELECT DISTINCT a, b, status, t, o1, o2, v, start_time, final_end_time, final_end_reason
  FROM nb2 WHERE ns IN (0, 1))""".strip())
    final = {
        "init": "SELECT * FROM init",
        "p1": "SELECT * FROM p1",
        "valid": "SELECT * FROM p2",
        "cands": "SELECT *, " + _REASON_CASE.format(o="end_reason_ordinal") + " AS end_reason_name FROM cands",
        "final": "SELECT * FROM fin",
        "merged": "SELECT * FROM merged",
    }[upto]
    return "WITH " + ",\n".join(parts) + "\n" + final


def payload_sql(policy: str, filters: list[str], payload: list[str]) -> str:
    """The merged ranges with the payload of the start row whose payload sorts first."""
    cols = ", ".join(payload)
    starts = "('start', 'update')" if policy == "assume_start" else "('start')"
    events = MATCH_EVENTS_SQL.replace("FROM (SELECT *", f", {cols} FROM (SELECT *", 1)
    order = ", ".join(f"{c} NULLS FIRST" for c in payload)
    return f"""SELECT r.*, {", ".join("p." + c for c in payload)} FROM ({match_sql(policy, filters)}) r
JOIN (SELECT a, b, t, {cols} FROM ({events}) e WHERE status IN {starts} AND a IS NOT NULL AND b IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY a, b, t ORDER BY {order}) = 1) p
  ON p.a = r.a AND p.b = r.b AND p.t = r.start_time"""
