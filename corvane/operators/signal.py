"""Signal operators over array columns of samples in [-1, 1]; NumPy inside Arrow batches."""

from __future__ import annotations

import io
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_row(kind: str, f, *cols):
    if len(cols) == 1:

        @F.pandas_udf(kind)
        def one(x: pd.Series) -> pd.Series:
            return pd.Series([f(v) for v in x])

        return one(*cols)

    @F.pandas_udf(kind)
    def two(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([f(v, w) for v, w in zip(x, y)])

    return two(*cols)


def _a(x):
    import numpy as np

    return np.zeros(0) if x is None else np.asarray(x, dtype=np.float64)


def db(x: Column) -> Column:
    """20 log10, floored at -120."""
    return F.when(x > 1e-6, 20 * F.log10(x)).otherwise(F.lit(-120.0))


def rms_dbfs(x: Column) -> Column:
    n = F.size(x)
    return F.when(n > 0, F.round(db(F.sqrt(F.aggregate(x, F.lit(0.0), lambda t, v: t + v.cast("double") * v.cast("double")) / n)), 4))


def peak_dbfs(x: Column) -> Column:
    return F.when(F.size(x) > 0, F.round(db(F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))), 4))


def frame_energies(x, size: int):
    import numpy as np

    a = _a(x)
    n = len(a) // size
    return np.sqrt((a[: n * size].reshape(n, size) ** 2).mean(axis=1)) if n else np.zeros(0)


def non_silent_ratio(x: Column, size: int, floor_db: float = -45.0) -> Column:
    """Share of whole frames louder than the floor; 0 without a whole frame."""
    limit = 10 ** (floor_db / 20)

    def f(v):
        e = frame_energies(v, size)
        return round(float((e > limit).mean()), 4) if len(e) else 0.0

    return _per_row("double", f, x)


def vad_ratio(x: Column, size: int, threshold: float = 0.01) -> Column:
    """Share of frames with an energy over the threshold, 4 digits."""

    def f(v):
        e = frame_energies(v, size)
        return round(float((e > threshold).mean()), 4) if len(e) else 0.0

    return _per_row("double", f, x)


def snr_db(x: Column, size: int) -> Column:
    """10 log10 of mean power over that of the quietest tenth of the frames; null without frames."""
    import numpy as np

    def f(v):
        p = np.sort(frame_energies(v, size) ** 2)
        if not len(p):
            return None
        noise = p[: max(1, len(p) // 10)].mean()
        return round(float(10 * np.log10(max(p.mean(), 1e-12) / max(noise, 1e-12))), 4)

    return _per_row("double", f, x)


def resample(x: Column, source: int, target: int) -> Column:
    """Band-limited resampling through the spectrum to int(n target / source) samples."""
    import numpy as np

    def f(v):
        a = _a(v)
        n = int(len(a) * target / source)
        if source == target or not len(a) or not n:
            return a[:n].tolist() if source != target else a.tolist()
        spec, k = np.fft.rfft(a), n // 2 + 1
        kept = np.zeros(k, complex)
        m = min(k, len(spec))
        kept[:m] = spec[:m]
        return (np.fft.irfft(kept, n) * (n / len(a))).tolist()

    return _per_row("array<double>", f, x)


def denoise(x: Column, gate_db: float = -40.0) -> Column:
    """Spectral gate: bins quieter than the peak by more than the gate are cleared."""
    import numpy as np

    def f(v):
        a = _a(v)
        if not len(a):
            return []
        spec = np.fft.rfft(a)
        mag = np.abs(spec)
        spec[mag < mag.max() * 10 ** (gate_db / 20)] = 0
        return np.fft.irfft(spec, len(a)).tolist()

    return _per_row("array<double>", f, x)


def add_noise(x: Column, key: Column, snr: float, seed: int = 0) -> Column:
    """White noise at the given ratio, seeded by the row's key."""
    import zlib

    import numpy as np

    def f(v, k):
        a = _a(v)
        if not len(a):
            return []
        rng = np.random.default_rng([seed, zlib.crc32(str(k).encode())])
        power = float((a**2).mean()) or 1e-12
        return (a + rng.normal(0, np.sqrt(power / 10 ** (snr / 10)), len(a))).tolist()

    return _per_row("array<double>", f, x, key)


def change_speed(x: Column, factor: float) -> Column:
    """Played ``factor`` times as fast: linear interpolation to int(n / factor) samples."""
    import numpy as np

    def f(v):
        a = _a(v)
        n = int(len(a) / factor)
        return np.interp(np.linspace(0, max(len(a) - 1, 0), n), np.arange(len(a)), a).tolist() if n else []

    return _per_row("array<double>", f, x)


def change_volume(x: Column, gain_db: float) -> Column:
    g = 10 ** (gain_db / 20)
    return F.transform(x, lambda v: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), v.cast("double") * g)))


def pad_to_bucket(x: Column, buckets: list[int]) -> Column:
    """Zeros up to the first bucket length that holds the signal; never cut."""
    size = F.size(x)
    target = F.coalesce(*[F.when(size <= b, b) for b in sorted(buckets)], size)
    return F.concat(F.transform(x, lambda v: v.cast("double")), F.array_repeat(F.lit(0.0), (target - size).cast("int")))


def pcm_to_wav(content: Column, rate: int, channels: int = 1) -> Column:
    """16-bit PCM as a WAV file; bytes that already are one pass through."""

    def f(b):
        b = bytes(b or b"")
        if b[:4] == b"RIFF" and b[8:12] == b"WAVE":
            return b
        out = io.BytesIO()
        out.write(b"RIFF" + struct.pack("<I", 36 + len(b)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * channels * 2, channels * 2, 16) + b"data" + struct.pack("<I", len(b)) + b)
        return out.getvalue()

    return _per_row("binary", f, content)


def energy_evidence(df: DataFrame, x: str, rate: int, frame_ms: int = 20) -> DataFrame:
    """Adds duration_ms, rms_dbfs, peak_dbfs, non_silent_ratio and energy_state."""
    from corvane.operators.classify import energy_state

    d = df.withColumns({"duration_ms": (F.size(x) * 1000 / rate).cast("long"), "rms_dbfs": rms_dbfs(F.col(x)), "peak_dbfs": peak_dbfs(F.col(x)), "non_silent_ratio": non_silent_ratio(F.col(x), max(1, rate * frame_ms // 1000))})
    return d.withColumn("energy_state", energy_state(F.col("duration_ms"), F.col("rms_dbfs"), F.col("peak_dbfs"), F.col("non_silent_ratio")))
