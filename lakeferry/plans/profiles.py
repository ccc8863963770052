"""What each kind of mask does.

``COMPAT`` gives the results users of the earlier loader know, including its
oddities. ``strict()`` mends those that leak: phones that pass unmasked, long
names, unsalted hashes, and sensitive columns with no mask at all.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, SparkSession

from lakeferry.functions import masking
from lakeferry.operators.projection import Mask


@dataclass(frozen=True)
class Profile:
    name: str
    masks: Mapping[str, Mask]

    @property
    def is_strict(self) -> bool:
        return self.name == "strict"


COMPAT = Profile(
    "compat",
    {
        "name": masking.mask_name,
        "phone": masking.mask_phone,
        "short_phone": masking.mask_phone_short,
        "hash": masking.hash_token,
    },
)


@dataclass(frozen=True)
class HashKey:
    """A key for hashes, and the id that hashes made with it bear.

    Its pads are columns that look up a frame of one row, so plans hold
    neither them nor the key: ``explain`` and event logs show a subquery. With another id
    and key, old hashes stay apart from new ones.
    """

    key_id: str
    inner: Column
    outer: Column

    @staticmethod
    def of(spark: SparkSession, key_id: str, key: bytes) -> HashKey:
        if len(key) < 16:
            raise ValueError("a key this short can be found by trial")
        pads = spark.createDataFrame(
            [tuple(map(bytearray, masking.hmac_pads(key)))], "inner binary, outer binary"
        )
        return HashKey(key_id, pads.select("inner").scalar(), pads.select("outer").scalar())

    def mask(self, column: Column | str) -> Column:
        return masking.keyed_token(column, self.inner, self.outer, self.key_id)


def strict(salt: str | None = None, key: HashKey | None = None) -> Profile:
    """Needs a salt or a key: card numbers are few enough to be found by trial.

    A salt is a literal of the plan, which ``explain`` and event logs show; a key is not.
    """
    if not salt and not key:
        raise ValueError("the strict profile needs a salt or a key")
    return Profile(
        "strict",
        {
            "name": masking.mask_name_strict,
            "phone": masking.mask_phone,
            "short_phone": masking.mask_phone,
            "hash": key.mask if key else partial(masking.hash_token, salt=salt),
        },
    )
