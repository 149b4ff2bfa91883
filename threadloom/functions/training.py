"""Fixed-length training arrays."""

from pyspark.sql import Column, functions as F

from threadloom.constants import IGNORE_LABEL, MAX_TOKENS


def encode_examples(
    input_ids: Column,
    target_ids: Column,
    eos_id: int,
    pad_id: int | None = None,
    max_length: int = MAX_TOKENS,
) -> Column:
    """Struct of ``input_ids``, ``attention_mask`` and ``labels``, each ``max_length`` long.

    The input is cut first; target and end mark get whatever room is left.
    """
    pad = eos_id if pad_id is None else pad_id
    none = F.array().cast("array<int>")
    source = F.slice(F.coalesce(input_ids, none), 1, max_length)
    room = F.lit(max_length) - F.size(source)
    target = F.slice(
        F.array_append(F.coalesce(target_ids, none), F.lit(eos_id)), F.lit(1), room
    )
    used = F.size(source) + F.size(target)
    rest = F.lit(max_length) - used

    def filled(value, count):
        return F.array_repeat(F.lit(value), count)

    return F.struct(
        F.concat(source, target, filled(pad, rest)).alias("input_ids"),
        F.concat(filled(1, used), filled(0, rest)).alias("attention_mask"),
        F.concat(
            filled(IGNORE_LABEL, F.size(source)), target, filled(IGNORE_LABEL, rest)
        ).alias("labels"),
    )
