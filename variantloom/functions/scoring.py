"""Column expressions of scores, priors and Bayes factors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prior variance, and the least p value told from 0.
PRIOR_VARIANCE = 0.0025
LEAST_P = 4.2e-317


#: Coefficients, lowest power first, of Wichura's rational approximations of the normal quantile (AS 241):
#: numerator and denominator for the middle, the near and the far tail.
MIDDLE = ((3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
          (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
NEAR_TAIL = ((1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
             (1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
FAR_TAIL = ((6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
            (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def half_up(c: Column, places: int) -> Column:
    """round(c, places) of a double. Spark's round writes and reads it as a decimal text; here that is done only within a
    thousandth of a half, sooner for large numbers and always from 2 ** 40 units on; elsewhere arithmetic gives the same."""
    y = c * F.lit(10.0**places)
    return F.when(F.abs(y - F.rint(y)) + F.abs(y) * 2.0**-41 < 0.499, F.rint(y) / F.lit(10.0**places) + F.lit(0.0)).otherwise(F.round(c, places))


def _ratio(x: Column, coefficients: tuple) -> Column:
    above, below = (F.lit(0.0), F.lit(0.0))
    for a, b in zip(reversed(coefficients[0]), reversed(coefficients[1]), strict=True):
        above, below = above * x + F.lit(a), below * x + F.lit(b)
    return above / below


def half_quantile(p: Column) -> Column:
    """-inv_cdf(p / 2) of the normal distribution, in built-in arithmetic; null outside 0 .. 1. The least p is LEAST_P."""
    q = F.greatest(p, F.lit(LEAST_P)) / 2
    r = F.sqrt(-F.ln(q))
    middle = (0.5 - q) * _ratio(0.180625 - (0.5 - q) * (0.5 - q), MIDDLE)
    z = F.when(0.5 - q <= 0.425, middle).when(r <= 5, _ratio(r - 1.6, NEAR_TAIL)).otherwise(_ratio(r - 5.0, FAR_TAIL))
    return F.when((p >= 0) & (p <= 1), z)


def z_from_p(p: Column, direction: Column) -> Column:
    """Z score of a two-sided p value with the sign of direction."""
    return half_quantile(p.cast("double")) * F.signum(direction)


def z_of_association(p: Column, odds_ratio: Column, beta: Column) -> tuple[Column, Column]:
    """(z, beta): by the odds ratio if known (direction OR - 1, beta ln OR), else by beta."""
    known = odds_ratio.isNotNull()
    return z_from_p(p, F.when(known, odds_ratio - 1).otherwise(beta)), F.when(known, F.ln(odds_ratio)).otherwise(beta)


def pics_probability(ld: Column, minus_log_p: Column) -> Column:
    """Unnormalised probability of a SNP with this LD to the top SNP, whose -log10 p is given; 1 where the deviation is 0."""
    sd = F.sqrt(1 - F.pow(F.sqrt(ld), F.lit(6.4))) * F.sqrt(minus_log_p) / 2
    z = (minus_log_p - ld * minus_log_p) / sd
    return F.when(sd > 0, 1 - F.exp(-z * z / 2) / (sd * F.lit(2.5))).otherwise(F.lit(1.0))


def total_score(pics: Column, gene: Column, exponent: float = 0.0) -> Column:
    """((A + B) / 2) cubed, with A = pics * pics ** exponent and B alike."""
    a, b = (x * F.pow(x, F.lit(exponent)) if exponent else x for x in (pics, gene))
    return F.pow((a + b) / 2, F.lit(3.0))


def log_bf_single(z: Column, n: Column, v: float = PRIOR_VARIANCE) -> Column:
    nv = n * F.lit(v)
    return -0.5 * F.ln(1 + nv) + 0.5 * z * z / (1 / nv + 1)


def log_bf_pair(z1: Column, z2: Column, r: Column, n: Column, b1: Column, b2: Column, v: float = PRIOR_VARIANCE, most_r: float = 0.9, eigen: float = 0.1) -> Column:
    """Log Bayes factor of two SNPs with correlation r and effects b1, b2.

    0 if |r| > most_r, or if the correlation matrix of trait and SNPs (trait correlation b * sqrt(1/2)) has an eigenvalue
    of at most `eigen` (by the leading minors of the matrix less `eigen`)."""
    nv = n * F.lit(v)
    det = (1 + nv) * (1 + nv) - nv * r * nv * r
    a = 1 / nv + 1
    quad = (a * (z1 * z1 + z2 * z2) - 2 * r * z1 * z2) / (a * a - r * r)
    c1, c2, d = b1 * F.lit(math.sqrt(0.5)), b2 * F.lit(math.sqrt(0.5)), F.lit(1 - eigen)
    positive = (d * d - c1 * c1 > 0) & (d * (d * d - r * r) - c1 * (c1 * d - r * c2) + c2 * (c1 * r - d * c2) > 0)
    return F.when((F.abs(r) > most_r) | ~positive, F.lit(0.0)).otherwise(-0.5 * F.ln(det) + 0.5 * quad)


def log_bf_gprior(z: Sequence[Column], n: Column, r: Column | None = None, g: str = "BRIC", compat: bool = False) -> Column:
    """Log Bayes factor by Zellner's prior for one or two SNPs; g is BRIC (max of size and n), BIC (n) or RIC (size).

    With compat the size in the penalty is 1, whatever the number of SNPs."""
    m = len(z)
    gp = {"BRIC": F.greatest(F.lit(float(m)), n.cast("double")), "BIC": n.cast("double"), "RIC": F.lit(float(m))}[g]
    quad = z[0] * z[0] if m == 1 else F.try_divide(z[0] * z[0] + z[1] * z[1] - 2 * r * z[0] * z[1], 1 - r * r)
    return F.lit(-(1 if compat else m) / 2) * F.ln(1 + gp) + 0.5 * gp / (gp + 1) * quad


def log_sum(a: Column, b: Column) -> Column:
    """ln(exp a + exp b)."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def log_prior_binomial(size: Column, kmax: int, m: Column) -> Column:
    """Binomial prior of a set of `size` out of m SNPs with p = 1 / m; for kmax > 1 relative to the sum over sizes.
    The one set of a single SNP has p = 1."""
    lp, lq = F.ln(1 / m), F.when(m > 1, F.ln(1 - 1 / m)).otherwise(F.lit(0.0))
    own = size * lp + (m - size) * lq
    if kmax == 1:
        return own
    total = lp + (m - 1) * lq
    for i in range(2, kmax + 1):
        total = log_sum(total, i * lp + (m - 1) * lq)
    return own - total


def approximate_variance(maf: Column, n: Column, controls: Column | None = None) -> Column:
    """Variance of an effect: 1 / (maf (1 - maf) n), 10 where maf is 0. With controls (n being the cases) that of a
    log odds ratio under Hardy-Weinberg shares, 0.0001 where maf is 0."""
    if controls is None:
        return F.when(maf == 0, F.lit(10.0)).otherwise(F.try_divide(F.lit(1.0), maf * (1 - maf) * n))
    q = F.least(maf, 1 - maf)
    second, first = 2 * q * (1 - q) + 4 * q * q, 2 * q * (1 - q) + 2 * q * q
    return F.when(q == 0, F.lit(0.0001)).otherwise(F.try_divide(n + controls, n * controls * (second - first * first)))


def log_abf(z: Column, maf: Column, n: Column, w: Sequence[float] = (0.01, 0.1, 0.5), controls: Column | None = None) -> Column:
    """Log of the mean over prior variances w of -ln sqrt(1 - r) - z z r / 2, r = w / (v + w)."""
    v, total = approximate_variance(maf, n, controls), None
    for x in w:
        r = x / (v + x)
        one = -0.5 * F.ln(1 - r) - z * z * r / 2
        total = one if total is None else log_sum(total, one)
    return total - math.log(len(w))
