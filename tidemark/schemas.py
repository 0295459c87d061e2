"""Record schemas and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql import types as T

# The five order states of the record contract.
ORDER_STATUSES = ("PLACED", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED")

# Defaults of the fields that version 2 of the order record adds.
V2_DEFAULTS = {"region": "UNKNOWN", "customer_email": None}


def _record(**fields: T.DataType) -> T.StructType:
    out = T.StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


_S, _D, _TS, _B = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.BooleanType()
_I, _L = T.IntegerType(), T.LongType()

BASIC_ORDER = _record(order_id=_S, customer_id=_S, amount=_D, status=_S, created_at=_TS)
ORDER_EVENT = _record(message_id=_S, order_id=_S, customer_id=_S, amount=_D, items=_S,
                      status=_S, created_at=_TS)
PAYMENT_EVENT = _record(order_id=_S, payment_id=_S, payment_method=_S, payment_status=_S,
                        amount=_D, created_at=_TS)
INVENTORY_EVENT = _record(product_id=_S, product_name=_S, quantity=_I, event_type=_S,
                          warehouse_id=_S, created_at=_TS)
JOB_MESSAGE = _record(message_id=_S, exchange=_S, exchange_type=_S, routing_key=_S,
                      payload=_S, created_at=_TS)
BINDING = _record(exchange=_S, exchange_type=_S, binding_key=_S, queue=_S)
HEADER_BINDING = _record(exchange=_S, headers=T.MapType(_S, _S), match=_S, queue=_S)
ORDER_V1 = _record(message_id=_S, order_id=_S, customer_id=_S, amount=_D, status=_S,
                   created_at=_S)
ORDER_V2 = T.StructType(list(ORDER_V1.fields)).add("region", _S).add("customer_email", _S)
PLACED_ORDER = _record(message_id=_S, order_id=_S, customer_id=_S, customer_email=_S,
                       customer_phone=_S, amount=_D, items=_S, status=_S, created_at=_S)
ENRICHED_ORDER = _record(order_id=_S, customer_id=_S, order_amount=_D, items=_S,
                         order_status=_S, order_created_at=_TS, payment_id=_S,
                         payment_method=_S, payment_status=_S, payment_created_at=_TS,
                         join_type=_S)
METRIC_SAMPLE = _record(metric=_S, labels=T.MapType(_S, _S), ts=_TS, value=_D)
BUCKET_SAMPLE = _record(metric=_S, ts=_TS, le=_D, cum_count=_D)

# Avro texts for the framed-record source and sink.
_AVRO_STATUS = ('{"type": "enum", "name": "OrderStatus", "symbols": ["'
                + '", "'.join(ORDER_STATUSES) + '"]}')


def avro_schema(name: str, record: T.StructType) -> str:
    """Avro record text for a flat record of strings and doubles.

    ``status`` becomes the enum; fields with a version-2 default carry it.
    """
    parts = []
    for field in record.fields:
        if field.name == "status":
            kind = _AVRO_STATUS
        elif isinstance(field.dataType, T.DoubleType):
            kind = '"double"'
        else:
            kind = '"string"'
        if field.name in V2_DEFAULTS:
            default = V2_DEFAULTS[field.name]
            if default is None:
                parts.append(f'{{"name": "{field.name}", "type": ["null", {kind}], "default": null}}')
            else:
                parts.append(f'{{"name": "{field.name}", "type": {kind}, "default": "{default}"}}')
        else:
            parts.append(f'{{"name": "{field.name}", "type": {kind}}}')
    return f'{{"type": "record", "name": "{name}", "fields": [{", ".join(parts)}]}}'
