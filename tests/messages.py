"""Change messages about readings of meters, written by hand. A reading's key is its meter and its slot of the day."""

import base64
import json
from datetime import datetime, timezone
from decimal import Decimal
from itertools import count

COMMITTED = datetime(2025, 3, 30, 1, 15, tzinfo=timezone.utc)
COMMIT_US = int(COMMITTED.timestamp()) * 1_000_000


def column(name, wire, logical=None, optional=True, **parameters):
    """How a message describes a column."""
    return {
        "type": wire,
        "optional": optional,
        **({"name": logical} if logical else {}),
        **({"parameters": {k: str(v) for k, v in parameters.items()}} if parameters else {}),
        "field": name,
    }


def number(name, scale, precision=None):
    """A decimal column. Sources that know no precision don't tell it."""
    told = {"connect.decimal.precision": precision} if precision else {}
    return column(name, "bytes", "org.apache.kafka.connect.data.Decimal", scale=scale, **told)


METER = column("meter", "string", optional=False)
SLOT = column("slot", "int32", optional=False)
KEY = (METER, SLOT)
KWH = number("kwh", 3, 9)
STATE = column("state", "string", "io.debezium.data.Enum")
TAKEN = column("taken", "string", "io.debezium.time.ZonedTimestamp")
OK = column("ok", "boolean")
FIRST = (METER, SLOT, KWH, STATE, TAKEN, OK)
LATER = (METER, SLOT, column("note", "string"), KWH, STATE, TAKEN, OK)


def digits(value, scale=3):
    """A decimal as a message has it: its digits as a signed number, in as few bytes as hold it."""
    whole = int(Decimal(value) * 10**scale)
    for width in count(1):
        try:
            return base64.b64encode(whole.to_bytes(width, signed=True)).decode()
        except OverflowError:
            continue


def reading(slot, state="raw", kwh="0.375", meter="north", **more):
    taken = COMMITTED.replace(minute=slot % 60).isoformat()
    return {"meter": meter, "slot": slot, "kwh": digits(kwh), "state": state, "taken": taken, "ok": slot % 2 == 0} | more


def change(op, image, pos, *, row=0, file=11, fields=FIRST, table="readings", keys=KEY, ts_us=COMMIT_US, blanks=False,
           offset=None, **source):
    """(topic, key, value, partition, offset) of one change."""

    def text(fields, payload):
        schema = {"type": "struct", "fields": fields}
        separators = (" , ", " : ") if blanks else (",", ":")
        return json.dumps({"schema": schema, "payload": payload}, separators=separators)

    place = {"file": f"binlog.{file:06d}", "pos": pos, "row": row, "ts_us": ts_us, "ts_ms": COMMIT_US // 1000}
    images = {"before": image, "after": None} if op == "d" else {"before": None, "after": image}
    parts = [{"type": "struct", "fields": list(fields), "optional": True, "field": side} for side in images]
    parts += [{"type": "struct", "fields": [], "field": "source"}, {"type": "string", "field": "op"}]
    own = {k["field"]: image[k["field"]] for k in keys} if image else {}
    return (
        f"plant.db.{table}",
        text(list(keys), own) if keys else None,
        text(parts, {**images, "source": place | source, "op": op}),
        0,
        pos if offset is None else offset,
    )
