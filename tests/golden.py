"""One entity with everything on it, and the row every target must make of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.text import instant
from tidemark.operators.envelope import envelope, serialize_cells
from tidemark.sources.entities import EDGE_TYPE

ID = "0b9e4a57-52c1-4f08-8d33-6f1ce2a97a10"
STREAM = "9d0c6e3b-7a14-4c5e-b1f2-2a8840d1735e"
PROVIDER = "61f7a2d8-04be-4e9a-9c67-d5b0318ce42f"
CODE_VALUE = "IMO-7712903"
CODE = f"/Vessel#Registry:{CODE_VALUE}"
NOW = dt.datetime(2025, 11, 3, 14, 5)
VOCABULARY = {
    "vessel.callSign": "MDN7",
    "vessel.crew": "24",
    "vessel.launched": "1998-06-07T08:09:10",
    "vessel.refitted": "2019-03-04T05:06:07-02:30",
}
OUT_KIND, IN_KIND = "/DocksAt", "/OwnedBy"
PORT, OWNER = "/Port#Unlocode:NLRTM", "/Company#Ledger:88"
IN_EDGE = f"EdgeType: {IN_KIND}; From: §C:{CODE}; To: §C:{OWNER}; Properties: 0"
OUT_EDGE = f"EdgeType: {OUT_KIND}; From: §C:{PORT}; To: §C:{CODE}; Properties: 0"
NAME = "Meridian of Delft"
SYSTEM = {
    "Id": ID,
    "ContainerName": "test",
    "EntityType": "/Vessel",
    "Name": NAME,
    "OriginEntityCode": CODE,
    "PersistHash": "kY3vQmB1tZpL0sXaWd9fHw==",
    "ProviderDefinitionId": PROVIDER,
    "Timestamp": "2025-11-03T16:05:00.0000000+02:00",
}
EPOCH, VERSION = 1762178700000, 1

_SCHEMA = f"""stream_id string, id string, change_type string, ts timestamp_ntz, seq bigint,
  persist_hash string, persist_version int, origin_entity_code string, entity_type string,
  properties map<string,string>, codes array<struct<type: string, origin: string, value: string>>,
  outgoing_edges array<{EDGE_TYPE}>, incoming_edges array<{EDGE_TYPE}>"""


def _edge(kind, source, target):
    return ((kind,), (None, (source,)), (None, (target,)), None)


def entity(spark, change_type="Added", ts=NOW, seq=1, **properties):
    row = (
        STREAM, ID, change_type, ts, seq, SYSTEM["PersistHash"], VERSION, CODE, "/Vessel",
        {"Name": NAME, **VOCABULARY, **properties},
        [("/Vessel", "Registry", CODE_VALUE)],
        [_edge(OUT_KIND, PORT, CODE)],
        [_edge(IN_KIND, CODE, OWNER)],
    )
    return spark.createDataFrame([row], _SCHEMA)


def stored(entities):
    """The change as the store keeps it: cells are values or JSON text."""
    declared = dict.fromkeys(("Name", *VOCABULARY), "string")
    wide = envelope(
        entities, declared, PROVIDER, "test", instant("2025-11-03 14:05:00"),
        outgoing_edges=True, incoming_edges=True, offset="+02:00",
    )
    return serialize_cells(wide).withColumn("PersistVersion", F.col("PersistVersion").cast("int"))


def expected(escaped: bool) -> dict:
    names = {k.replace(".", "_") if escaped else k: v for k, v in VOCABULARY.items()}
    return {**SYSTEM, **names}
