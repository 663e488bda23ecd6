"""SQL texts shared by the oracles."""

from __future__ import annotations


def guid(text: str) -> str:
    h = f"md5({text})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "(" + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in cuts) + ")"


def stream(number: str) -> str:
    return guid(f"'stream-' || CAST({number} AS VARCHAR)")


def micros(ts: str) -> str:
    """A time as text, six fraction digits."""
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


EVENTS = f"""ev AS (
  SELECT {stream('user_id % 20')} AS stream_id, CAST(user_id AS VARCHAR) AS id,
    CASE event_type WHEN 'signup' THEN 'Added' WHEN 'error' THEN 'Removed' ELSE 'Changed' END AS change_type,
    ts, event_id AS seq, event_type, value, props
  FROM events)"""

LINEITEM = f"""li AS (
  SELECT {stream('l_orderkey % 20')} AS stream_id, CAST(l_orderkey AS VARCHAR) AS id,
    CASE l_returnflag WHEN 'A' THEN 'Added' WHEN 'R' THEN 'Removed' ELSE 'Changed' END AS change_type,
    l_shipdate AS ts,
    CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS seq,
    l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
    l_linestatus AS linestatus
  FROM lineitem)"""

EVENTS_PAYLOAD = ("event_type", "value", "props")
LINEITEM_PAYLOAD = ("quantity", "price", "discount", "tax", "linestatus")


def hard_versions(log: str, name: str = "ver") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, ts AS valid_from,
      coalesce(lead(ts) OVER (PARTITION BY stream_id, id ORDER BY ts, seq), TIMESTAMP '9999-12-31') AS valid_to
    FROM {log})
  WHERE change_type <> 'Removed')"""


def soft_versions(log: str, payload: tuple[str, ...], name: str = "ver") -> str:
    """The payload of the last live change, carried along as one struct."""
    packed = ", ".join(f"{c} := {c}" for c in payload)
    kept = ", ".join(f"live.{c} AS {c}" for c in payload)
    return f"""numbered AS (
  SELECT stream_id, id, change_type, ts, seq,
    coalesce(lead(ts) OVER (PARTITION BY stream_id, id ORDER BY ts, seq), TIMESTAMP '9999-12-31') AS next_ts,
    last_value(CASE WHEN change_type <> 'Removed' THEN struct_pack({packed}) END IGNORE NULLS) OVER (
      PARTITION BY stream_id, id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS live
  FROM {log}),
{name} AS (
  SELECT stream_id, id, change_type, ts AS valid_from, next_ts AS valid_to, seq, {kept}
  FROM numbered WHERE live IS NOT NULL)"""
