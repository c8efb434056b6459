"""Rotations and poses in scalar SQL: rows of a matrix are r0 .. r8, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY_POSE = (0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0)


def identity_pose() -> Column:
    return F.array(*[F.lit(x).cast("float") for x in IDENTITY_POSE])


def named(prefix: str, values: list[Column]) -> dict[str, Column]:
    return {f"{prefix}{i}": v for i, v in enumerate(values)}


def cols(prefix: str, n: int = 9) -> list[Column]:
    return [F.col(f"{prefix}{i}").cast("double") for i in range(n)]


def matmul(a: list[Column], b: list[Column]) -> list[Column]:
    return [sum((a[3 * i + k] * b[3 * k + j] for k in range(1, 3)), a[3 * i] * b[j]) for i in range(3) for j in range(3)]


def transpose(a: list[Column]) -> list[Column]:
    return [a[3 * j + i] for i in range(3) for j in range(3)]


def apply(a: list[Column], v: list[Column]) -> list[Column]:
    return [a[3 * i] * v[0] + a[3 * i + 1] * v[1] + a[3 * i + 2] * v[2] for i in range(3)]


def det(a: list[Column]) -> Column:
    return a[0] * (a[4] * a[8] - a[5] * a[7]) - a[1] * (a[3] * a[8] - a[5] * a[6]) + a[2] * (a[3] * a[7] - a[4] * a[6])


def to_6d(a: list[Column]) -> list[Column]:
    """The first two columns, one after the other."""
    return [a[0], a[3], a[6], a[1], a[4], a[7]]


def pose9(t: list[Column], rot: list[Column]) -> list[Column]:
    """Translation and six numbers of the rotation."""
    return [*t, *to_6d(rot)]


def from_6d(d: list[Column]) -> list[Column]:
    """Gram-Schmidt on two vectors; the third column is their cross product."""
    tiny = F.lit(1e-12)
    na = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) + tiny
    a = [d[i] / na for i in range(3)]
    along = a[0] * d[3] + a[1] * d[4] + a[2] * d[5]
    rest = [d[3 + i] - along * a[i] for i in range(3)]
    nb = F.sqrt(rest[0] * rest[0] + rest[1] * rest[1] + rest[2] * rest[2]) + tiny
    b = [x / nb for x in rest]
    c = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    return [a[0], b[0], c[0], a[1], b[1], c[1], a[2], b[2], c[2]]


def with_matrix(df: DataFrame, given: list[Column], prefix: str) -> DataFrame:
    """Adds from_6d() as columns, norm by norm, so that none is computed more than once."""
    p = f"{prefix}__"
    one = df.withColumns({f"{p}d{i}": x for i, x in enumerate(given)})
    d = [F.col(f"{p}d{i}") for i in range(6)]
    one = one.withColumn(f"{p}na", F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) + F.lit(1e-12))
    one = one.withColumns({f"{p}a{i}": d[i] / F.col(f"{p}na") for i in range(3)})
    a = [F.col(f"{p}a{i}") for i in range(3)]
    one = one.withColumn(f"{p}along", a[0] * d[3] + a[1] * d[4] + a[2] * d[5])
    one = one.withColumns({f"{p}e{i}": d[3 + i] - F.col(f"{p}along") * a[i] for i in range(3)})
    e = [F.col(f"{p}e{i}") for i in range(3)]
    one = one.withColumn(f"{p}nb", F.sqrt(e[0] * e[0] + e[1] * e[1] + e[2] * e[2]) + F.lit(1e-12))
    one = one.withColumns({f"{p}b{i}": e[i] / F.col(f"{p}nb") for i in range(3)})
    b = [F.col(f"{p}b{i}") for i in range(3)]
    c = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    made = one.withColumns(named(prefix, [a[0], b[0], c[0], a[1], b[1], c[1], a[2], b[2], c[2]]))
    return made.drop(*[x for x in made.columns if x.startswith(p)])


def is_rotation(a: list[Column], atol: float = 1e-4, rtol: float = 1e-5) -> Column:
    """Orthonormal with determinant one, within the tolerances."""
    gram = matmul(a, transpose(a))
    near = [F.abs(g - F.lit(1.0 if i % 4 == 0 else 0.0)) <= atol + rtol * (1.0 if i % 4 == 0 else 0.0) for i, g in enumerate(gram)]
    out = F.abs(det(a) - 1.0) <= atol + rtol
    for x in near:
        out = out & x
    return F.coalesce(out, F.lit(False))


def quaternion_matrix(q: list[Column]) -> list[Column]:
    """Rotation of a quaternion x, y, z, w, normalised with 1e-8 added to its norm."""
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3]) + F.lit(1e-8)
    x, y, z, w = (c / n for c in q)
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]


def quaternion_multiply(p: list[Column], q: list[Column]) -> list[Column]:
    (a, b, c, d), (x, y, z, w) = p, q
    return [d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z]


def quaternion_conjugate(q: list[Column]) -> list[Column]:
    return [-q[0], -q[1], -q[2], q[3]]


def relative_pose(rot: list[Column], t: list[Column], ref_rot: list[Column], ref_t: list[Column]) -> tuple[list[Column], list[Column]]:
    """World-to-camera pose relative to a reference one: R R_ref^T, t - R R_ref^T t_ref."""
    r = matmul(rot, transpose(ref_rot))
    moved = apply(r, ref_t)
    return r, [t[i] - moved[i] for i in range(3)]


def rigid_inverse(rot: list[Column], t: list[Column]) -> tuple[list[Column], list[Column]]:
    """R^T, -R^T t. Also a pose's camera centre."""
    r = transpose(rot)
    return r, [-x for x in apply(r, t)]


def geodesic_degrees(a: list[Column], b: list[Column]) -> Column:
    """Angle between two rotations."""
    trace = sum((a[i] * b[i] for i in range(1, 9)), a[0] * b[0])
    return F.degrees(F.acos(F.least(F.greatest((trace - 1.0) / 2.0, F.lit(-1.0)), F.lit(1.0))))


def relative_quaternion(q: list[Column], t: list[Column], ref_q: list[Column], ref_t: list[Column]) -> tuple[list[Column], list[Column]]:
    """q q_ref*, t - t_ref: a single frame's pose relative to a reference, without turning the move."""
    return quaternion_multiply(q, quaternion_conjugate(ref_q)), [x - y for x, y in zip(t, ref_t, strict=True)]
