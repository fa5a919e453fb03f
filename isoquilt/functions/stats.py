"""Distribution helpers: native Columns where closed forms exist, Arrow batches elsewhere."""

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def qnorm(prob: float, mean: float, sd: float) -> float:
    """Normal quantile (driver-side constant)."""
    return NormalDist(mean, sd).inv_cdf(prob)


def dnorm(x: Column, mean: Column, sd: Column) -> Column:
    """Normal density."""
    return F.exp(-F.pow((x - mean) / sd, 2) / 2) / (sd * math.sqrt(2 * math.pi))


def updated_sigma(var: Column, n: Column, sigma_start: float) -> Column:
    """Width of the start position prior after ``n`` matches."""
    return F.sqrt(var * (n + 1) / (n + 0.5)) + F.lit(sigma_start) / n


def beta_mean(a: Column, b: Column) -> Column:
    return a / (a + b)


def beta_var(a: Column, b: Column) -> Column:
    return a * b / (F.pow(a + b, 2) * (a + b + 1))


def beta_phi(a: Column, b: Column) -> Column:
    """Dispersion var / (mean (1 - mean)) of a beta distribution."""
    m = beta_mean(a, b)
    return beta_var(a, b) / (m * (1 - m))


def mean2var(m):
    """Variance of cluster sizes expected from PCR at mean ``m``."""
    return 2.566 * m - 2.566


def nbinom_kurtosis(m, v):
    """Kurtosis of a negative binomial with mean ``m`` and variance ``v``."""
    return 6 * (v - m) / (m * m) + 1 / v + 3


def variance_df(m, v, n):
    """Degrees of freedom of the chi-square law of a sample variance."""
    return 2 * n / (nbinom_kurtosis(m, v) - (n - 3) / (n - 1))


# Coefficients of the asymptotic series of the log-gamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360, 1 / 156)


def log_gamma(a) -> np.ndarray:
    """Log-gamma of positive numbers: moved above 10, then the asymptotic series."""
    a = np.asarray(a, dtype=float)
    lift = np.ones_like(a)
    x = a.copy()
    while np.any(x < 10):
        small = x < 10
        lift = np.where(small, lift * x, lift)
        x = np.where(small, x + 1, x)
    tail = sum(c / x ** (2 * k + 1) for k, c in enumerate(STIRLING))
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + tail - np.log(lift)


def gamma_p(a: np.ndarray, x: np.ndarray, log_a: np.ndarray | None = None) -> np.ndarray:
    """Regularised lower incomplete gamma function, elementwise.

    Power series below a + 1, continued fraction above.  ``log_a`` is log-gamma of ``a`` where known.
    """
    a = np.asarray(a, dtype=float)
    x = np.asarray(x, dtype=float)
    out = np.zeros_like(x)
    log_a = log_gamma(a) if log_a is None else log_a
    scale = np.exp(-x + a * np.log(np.maximum(x, 1e-300)) - log_a) if x.size else x
    low = (x > 0) & (x < a + 1)
    if low.any():
        aa, xx = a[low], x[low]
        term = 1.0 / aa
        total = term.copy()
        k = aa.copy()
        for _ in range(10000):
            k += 1
            term = term * xx / k
            total += term
            if np.all(np.abs(term) < np.abs(total) * 1e-15):
                break
        out[low] = total * scale[low]
    high = x >= a + 1
    if high.any():
        aa, xx = a[high], x[high]
        tiny = 1e-300
        b = xx + 1 - aa
        c = np.full_like(xx, 1 / tiny)
        d = 1 / b
        h = d.copy()
        for i in range(1, 10000):
            an = -i * (i - aa)
            b = b + 2
            d = an * d + b
            d = np.where(np.abs(d) < tiny, tiny, d)
            c = b + an / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            d = 1 / d
            delta = d * c
            h = h * delta
            if np.all(np.abs(delta - 1) < 1e-15):
                break
        out[high] = 1 - scale[high] * h
    return out


def chi2_cdf(x, df, log_half=None) -> np.ndarray:
    return gamma_p(np.asarray(df, dtype=float) / 2, np.asarray(x, dtype=float) / 2, log_half)


def chi2_quantile(prob, df) -> np.ndarray:
    """Chi-square quantile by bisection to the last bit (fractional degrees of freedom allowed)."""
    df = np.asarray(df, dtype=float)
    prob = np.broadcast_to(np.asarray(prob, dtype=float), df.shape)
    log_half = log_gamma(df / 2)
    lo = np.zeros_like(df)
    hi = np.maximum(df, 1.0) * 2
    while np.any(short := chi2_cdf(hi, df, log_half) < prob):
        hi = np.where(short, hi * 2, hi)
    while True:
        mid = (lo + hi) / 2
        if np.all((mid == lo) | (mid == hi)):
            return mid
        below = chi2_cdf(mid, df, log_half) < prob
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
