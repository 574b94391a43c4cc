"""F-hash: the polynomial string hash of the bitmap unique-visitor job.

``h = 0; for each char c: h = h * seed + code(c)``; result ``h & (cap - 1)``.
Masking in every step equals the single final mask because ``cap`` is a
power of two and the mask commutes with + and *; it also keeps every
intermediate below 2^35, so ANSI overflow checks never fire.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference job: seed 61, bitmap of 2^29 bits; 2^27 bits
# when a non-positive size is given.
DEFAULT_SEED = 61
DEFAULT_CAP = 1 << 29
FALLBACK_CAP = 1 << 27


def bitmap_capacity(size: int) -> int:
    return size if size > 0 else FALLBACK_CAP


def poly_hash(text: Column, seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP) -> Column:
    """Polynomial hash of a string column, masked to ``cap`` (a power of two).

    ``ascii`` returns the code point of the first character, which equals the
    JVM ``char`` for text in the Basic Multilingual Plane (ids are digits).
    """
    cap = bitmap_capacity(cap)
    if cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    mask = F.lit(cap - 1)
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("long"),
        lambda acc, ch: (acc * F.lit(seed) + F.ascii(ch).cast("long")).bitwiseAND(mask),
    )


def poly_hash_of_long(x: Column, seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP) -> Column:
    """:func:`poly_hash` of the decimal text of a BIGINT, in plain arithmetic.

    Read from the right, the text's k-th digit contributes
    ``(48 + digit) * seed^k``, so ``h = sum_k (48 + (x div 10^k) % 10) * seed^k``
    over the digits present, masked to ``cap``; the powers are constants
    reduced modulo ``cap``.  Every term is independent (no per-character
    loop), so the expression stays in generated code.  Negative ids fall
    back to :func:`poly_hash` of the text.
    """
    cap = bitmap_capacity(cap)
    mask = cap - 1
    x = x.cast("long")
    terms = []
    for k in range(19):  # a non-negative BIGINT has at most 19 digits
        # (x mod 10^(k+1) - x mod 10^k) is exactly digit * 10^k, a double without
        # rounding, so the division is exact even above 2^53
        upper = F.pmod(x, F.lit(10 ** (k + 1))) if k < 18 else x
        digit = ((upper - F.pmod(x, F.lit(10 ** k))) / F.lit(10 ** k)).cast("long")
        term = (digit + F.lit(48)) * F.lit(pow(seed, k, cap))
        terms.append(term if k == 0 else F.when(x >= F.lit(10 ** k), term).otherwise(F.lit(0)))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.when(x >= 0, total.bitwiseAND(F.lit(mask))).otherwise(
        poly_hash(x.cast("string"), seed, cap))
