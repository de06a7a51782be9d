"""Waveform arrays (inventory 2.11) as column expressions, a few in Python."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from undertone.functions.tokens import let

RATE = 16_000


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v)))


def normalized(x: Column) -> Column:
    """Divided by the largest absolute value (unchanged if that is 0)."""
    return let(x, lambda y: let(peak(y), lambda p: F.when(p > 0, F.transform(y, lambda v: v / p)).otherwise(y)))


def mean(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)


def standardized(x: Column) -> Column:
    """Mean 0, population deviation 1 (zeros if it has none)."""

    def scaled(y, mu):
        sd = F.sqrt(F.aggregate(y, F.lit(0.0), lambda a, v: a + (v - mu) * (v - mu)) / F.size(y))
        return let(sd, lambda s: F.transform(y, lambda v: F.when(s > 0, (v - mu) / s).otherwise(0.0)))

    return let(x, lambda y: let(mean(y), lambda mu: scaled(y, mu)))


def padded(x: Column, n: int) -> Column:
    """Cut or filled with zeros to n values."""
    return F.concat(F.slice(x, 1, n), F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(n) - F.size(x))))


def power(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / F.size(x)


def with_noise(x: Column, noise: Column, snr_db: Column) -> Column:
    """Noise standardised and scaled to the given signal-to-noise ratio."""

    def mixed(y):
        scale = F.sqrt(power(y) / F.pow(F.lit(10.0), snr_db / 10.0))
        return let(scale, lambda s: F.zip_with(y, standardized(noise), lambda a, b: a + s * b))

    return let(x, mixed)


def windows_sum(clips: Column, starts: Column, n: int) -> Column:
    """One window of n values of every (repeated) clip, normalised, summed."""

    def window(c, s):
        times = F.ceil((s + n) / F.size(c)).cast("int")
        return normalized(F.slice(F.flatten(F.array_repeat(c, times)), (s + 1).cast("int"), n))

    cut = F.zip_with(clips, starts, window)
    return F.aggregate(cut, F.array_repeat(F.lit(0.0), n), lambda a, w: F.zip_with(a, w, lambda p, q: p + q))


def peak_guard(x: Column) -> Column:
    """K7: divided by the peak if it is over 1."""
    return let(x, lambda y: let(peak(y), lambda p: F.when(p > 1, F.transform(y, lambda v: v / p)).otherwise(y)))


def room(x: Column, seed: Column, taps: int = 16, decay: float = 0.35) -> Column:
    """Convolution with decaying keyed noise, full length, peak kept."""

    @F.pandas_udf("array<double>")
    def run(s: pd.Series, k: pd.Series) -> pd.Series:
        def one(v, seed_):
            if v is None or len(v) == 0:
                return v
            g = np.random.Generator(np.random.PCG64(int(seed_))).standard_normal(taps) * np.exp(-decay * np.arange(taps))
            y = np.convolve(np.asarray(v, float), g / np.abs(g).max())
            return y / max(np.abs(y).max(), 1e-12)

        return pd.Series([one(v, q) for v, q in zip(s, k)])

    return run(x, seed)


FRAME, HOP = 512, 128


def vocoded(v: np.ndarray, rate: float) -> np.ndarray:
    """A phase vocoder: round(len / rate) values at the same pitch.

    Frames of the spectrum are read at steps of ``rate`` hops; magnitudes are
    interpolated, phases go on by what each bin turned between two frames.
    """
    n = max(1, int(round(len(v) / rate)))
    window = np.hanning(FRAME + 1)[:-1]
    padded_ = np.concatenate([np.zeros(FRAME // 2), v, np.zeros(FRAME + HOP)])
    spectrum = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(padded_, FRAME)[::HOP] * window, axis=1)
    at = np.arange(0, len(spectrum) - 1, rate)
    low = at.astype(int)
    part = (at - low)[:, None]
    size = np.abs(spectrum[low]) * (1 - part) + np.abs(spectrum[low + 1]) * part
    bins = 2 * np.pi * HOP * np.arange(FRAME // 2 + 1) / FRAME
    turn = np.angle(spectrum[low + 1]) - np.angle(spectrum[low]) - bins
    turn = bins + turn - 2 * np.pi * np.round(turn / (2 * np.pi))
    phase = np.angle(spectrum[0]) + np.concatenate([np.zeros((1, turn.shape[1])), np.cumsum(turn[:-1], axis=0)])
    frames = np.fft.irfft(size * np.exp(1j * phase), FRAME, axis=1) * window
    out, weight = np.zeros(HOP * len(frames) + FRAME), np.zeros(HOP * len(frames) + FRAME)
    for k, f in enumerate(frames):
        out[k * HOP : k * HOP + FRAME] += f
        weight[k * HOP : k * HOP + FRAME] += window**2
    y = (out / np.maximum(weight, 1e-3))[FRAME // 2 : FRAME // 2 + n]
    return np.concatenate([y, np.zeros(n - len(y))])


def resampled(v: np.ndarray, n: int) -> np.ndarray:
    """``n`` values by linear interpolation."""
    return np.interp(np.linspace(0, len(v) - 1, n), np.arange(len(v)), v)


def _effect(x: Column, amount: Column, f) -> Column:
    @F.pandas_udf("array<double>")
    def run(s: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([v if v is None or len(v) == 0 or q is None else f(np.asarray(v, float), float(q)) for v, q in zip(s, r)])

    return run(x, amount)


def stretched(x: Column, speed: Column) -> Column:
    """The speed changed, the pitch kept; null and empty stay."""
    return _effect(x, speed, vocoded)


def pitched(x: Column, semitones: Column) -> Column:
    """The pitch moved by semitones, the length kept; null and empty stay."""
    return _effect(x, semitones, lambda v, k: resampled(vocoded(v, 2.0 ** (-k / 12)), len(v)))


def header_seconds(data: Column) -> Column:
    """Frames over rate from a WAV header; null where there is none."""

    def one(b):
        try:
            with wave.open(io.BytesIO(b)) as w:
                return w.getnframes() / w.getframerate()
        except (wave.Error, EOFError, TypeError, ZeroDivisionError):
            return None

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one).astype("float64")

    return F.nanvl(run(data), F.lit(None).cast("double"))


def decode_wav(data: Column) -> Column:
    """Mono 16 kHz samples of WAV bytes; null if they can't be read."""

    def one(b):
        try:
            with wave.open(io.BytesIO(b)) as w:
                kind = {1: np.uint8, 2: np.int16, 4: np.int32}[w.getsampwidth()]
                v = np.frombuffer(w.readframes(w.getnframes()), kind).astype(float)
                v = (v - 128) / 128 if kind is np.uint8 else v / np.iinfo(kind).max
                v = v.reshape(-1, w.getnchannels()).mean(axis=1)
                if w.getframerate() != RATE and len(v):
                    n = int(round(len(v) * RATE / w.getframerate()))
                    v = np.interp(np.linspace(0, len(v) - 1, n), np.arange(len(v)), v)
                return v
        except (wave.Error, EOFError, KeyError, TypeError):
            return None

    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return run(data)


def encode_wav(x: Column) -> Column:
    """K7: 16-bit PCM WAV bytes of samples within the peak guard."""

    def one(v):
        if v is None:
            return None
        a = np.asarray(v, float)
        top = np.abs(a).max() if len(a) else 0.0
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(RATE)
            w.writeframes((np.clip(a / top if top > 1 else a, -1, 1) * 32767).round().astype("<i2").tobytes())
        return out.getvalue()

    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    return run(x)


def seconds_of(data: Column, n_bytes: Column | None = None) -> Column:
    """From the header, else bytes / 32,000, else 30."""
    return F.coalesce(header_seconds(data), (n_bytes if n_bytes is not None else F.length(data)) / 32000.0, F.lit(30.0))


def background_clips(df: DataFrame, sample: str, clip: str, seed: int, n: int = 8, shares: int = 4096) -> DataFrame:
    """With every row ``background``, up to ``n`` clips of the rows
    before it in a keyed order (a reservoir of fixed size). Rows are dealt to
    ``shares`` parts by a second hash, so no task orders all of them; null clips
    are no background, and the first row of a part has none."""
    w = W.partitionBy("__part").orderBy("__h", sample).rowsBetween(-n, -1)
    d = df.withColumn("__h", F.xxhash64(F.lit(seed), sample)).withColumn("__part", F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), sample), F.lit(shares)))
    return d.withColumn("background", F.collect_list(clip).over(w)).drop("__h", "__part")
