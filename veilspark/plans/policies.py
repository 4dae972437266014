"""Policies used by the registered queries over the driver tables."""

from __future__ import annotations

import datetime as dt

from veilspark.operators.versions import PolicyVersion
from veilspark.policy import Policy


def _p(*fields: dict, **meta) -> Policy:
    return Policy.from_dict({**meta, "fields": list(fields)})


def pii(name: str, op: str, type_: str = "string", **extra) -> dict:
    return {"name": name, "type": type_, "isPII": True, "piiOperation": op, **extra}


def plain(name: str, type_: str = "string") -> dict:
    return {"name": name, "type": type_, "isPII": False}


SUPPLIER_FORMAT = "XXXXXXXX#*******XX"
CUSTOMER_FORMAT = "XXXX****"
EVENT_TYPE_FORMAT = "X***"

MASK_DEFAULT = _p(pii("c_name", "mask"), pii("c_mktsegment", "mask"))
MASK_FORMAT = _p(pii("s_name", "mask", maskFormat=SUPPLIER_FORMAT))
MASK_NONSTRING = _p(pii("c_acctbal", "mask", "double"), pii("c_nationkey", "randomize", "boolean"))
HASH = _p(pii("c_name", "hash"), pii("c_custkey_text", "hash", "integer"), pii("c_acctbal", "hash", "double"))
REDACT = _p(pii("c_name", "redact"), pii("c_acctbal", "redact", "double"), pii("c_nationkey", "redact", "integer"))
GENERALIZE_DOUBLE = _p(pii("c_acctbal", "generalize", "double", ranges=[0, 1000, 2500, 5000, 7500]))
GENERALIZE_INT = _p(pii("p_size", "generalize", "integer", ranges=[10, 20, 30, 40]),
                    pii("p_size_text", "generalize", "string", ranges=[40, 30, 20, 10]),
                    pii("p_brand", "generalize", "string", ranges=[10, 20, 30, 40]))
GENERALIZE_WRAP = _p(pii("o_key", "generalize", "integer", ranges=[0, 500, 1000]),
                     pii("o_totalprice", "generalize", "double", ranges=[100000, 200000, 300000]))
GENERALIZE_NO_RANGES = _p(pii("p_size", "generalize", "integer"), pii("p_retailprice", "generalize", "double"),
                          pii("p_type", "generalize"))
RANDOMIZE = _p(pii("c_name", "randomize"), pii("c_nationkey", "randomize", "integer"),
               pii("c_acctbal", "randomize", "double"))
RANDOMIZE_PAIRS = _p(pii("t1", "randomize"), pii("t2", "randomize"), pii("i1", "randomize", "integer"), pii("i2", "randomize", "integer"),
                     pii("x1", "randomize", "double"), pii("x2", "randomize", "double"))
UNKNOWN_OP = _p(pii("p_name", "MASK", maskFormat="XX"), pii("p_size", "tokenize", "integer"))
CUSTOMER_COLUMNS = _p(plain("c_custkey"), pii("c_name", "hash"),
                      pii("c_nationkey", "generalize", "integer", ranges=[0, 5, 10, 15, 20]),
                      pii("c_acctbal", "redact", "double"), pii("c_phone", "mask"))
CUSTOMER_JSON = _p(plain("id"), pii("c_name", "mask", maskFormat=CUSTOMER_FORMAT),
                   pii("c_nationkey", "generalize", "integer", ranges=[0, 5, 10, 15, 20]),
                   plain("c_acctbal", "double"), pii("c_mktsegment", "redact"), pii("c_phone", "mask"))
EVENT_JSON = _p(plain("id"), pii("user_id", "hash", "integer"),
                pii("event_type", "mask", maskFormat=EVENT_TYPE_FORMAT),
                pii("value", "generalize", "double", ranges=[0, 100, 200, 300]),
                plain("props"), pii("day", "mask", "date"), pii("note", "redact", "integer"))
EVENT_DECLARED = _p(plain("id"), plain("user_id", "integer"), plain("event_type"))
CUSTOMER_VALIDATION = _p({"name": "id", "type": "string", "isPII": False, "required": True},
                         plain("c_name"), plain("c_nationkey", "integer"), plain("c_acctbal", "integer"),
                         plain("c_mktsegment", "boolean"), plain("c_phone"))
# each declared type twice: null allowed, null refused
MIXED_TYPES = ("string", "integer", "double", "boolean", "date")
MIXED_VALIDATION = _p(*[{"name": t + end, "type": t, "isPII": False, "required": bool(end)}
                        for t in MIXED_TYPES for end in ("", "_required")])
TURN_SIZES = _p({"name": "role", "type": "string", "isPII": False, "size": 6},
                {"name": "text", "type": "string", "isPII": False, "size": 120},
                {"name": "turn", "type": "integer", "isPII": False, "size": 1})
LINEITEM = _p(pii("l_partkey", "hash", "integer"), pii("l_suppkey", "generalize", "integer", ranges=[0, 250, 500, 750]),
              pii("l_quantity", "generalize", "double", ranges=[0, 10, 20, 30, 40, 50]),
              plain("l_extendedprice", "double"), pii("l_returnflag", "mask"), pii("l_linestatus", "redact"))
EVENT_FAULTS = _p(plain("id"), pii("user_id", "hash", "integer"), pii("event_type", "mask"))
DOCUMENTS = _p(pii("text", "mask"), pii("text_hash", "hash"), plain("lang"))

ASOF_VERSIONS = [
    PolicyVersion(dt.datetime(2024, 1, 1), _p(pii("event_type", "mask"), pii("user_id", "hash", "integer")), "v1"),
    PolicyVersion(dt.datetime(2024, 1, 10), _p(pii("event_type", "hash"),
                                               pii("user_id", "generalize", "integer", ranges=[0, 500, 1000])), "v2"),
    PolicyVersion(dt.datetime(2024, 1, 20), _p(pii("event_type", "redact")), "v3"),
]
CONVERSATIONS = _p(plain("turn", "integer"), pii("role", "mask", maskFormat="X***"), pii("text", "hash"),
                  pii("text_masked", "mask", maskFormat="XXXXXXXXXX"))
PAGES = _p(pii("url", "mask", maskFormat="XXXXXXXX"), pii("html", "redact"), pii("html_hash", "hash"))
DOCUMENTS_RANDOM = _p(pii("text", "randomize"))
CONVERSATION_JSON = _p(pii("role", "hash"), pii("text", "mask", maskFormat="X" * 20),
                      pii("turn", "generalize", "integer", ranges=[0, 2, 4, 8]))
KEYED_JSON = _p(plain("id"), pii("user_id", "hash"), plain("event_type"))
