"""The relations of the engine: the only place where their fields are declared."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


LABEL = _struct(value=S, lang=S)
FLOW = _struct(uuid=S, source=S, name=S, cas=T.ArrayType(S), ec=T.ArrayType(S), context=T.ArrayType(S), unit=S, synonyms=T.ArrayType(S), extra=T.MapType(S, S))
FLOW_OBJECT = _struct(object_id=S, pref=S, alts=T.ArrayType(S), cas=T.ArrayType(S), ec=T.ArrayType(S), qualifier=S)
ELEMENTARY_FLOW = _struct(flow_id=S, object_id=S, context_iri=S, words=T.ArrayType(S), unit=S, deprecated=B)
FACTOR = _struct(impl=S, flow=S, category=S, geo=S, amount=D)
INVENTORY = _struct(process=S, category=S, flow=S, amount=D)
OUTCOME = _struct(run=S, list=S, version=S, uuid=S, outcome=S, reason=S, target=S, basis=S)
CHANGE = _struct(uuid=S, step=L, field=S, before=S, after=S)
REDIRECT = _struct(id=S, replaced_by=S)
