"""Names and number texts used in comparison tables and charts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Method keys, their display names, and the four compared metrics.
PARAGRAPH_METHOD = "doc2vec"
WORD_BIN_METHOD = "word2vec_bow"
METHOD_NAMES = {PARAGRAPH_METHOD: "Doc2Vec", WORD_BIN_METHOD: "Word2Vec BoW"}
METRICS = ("cosine_silhouette", "davies_bouldin", "calinski_harabasz", "cluster_size_std")


def method_name(key: Column) -> Column:
    named = F.lit(None).cast("string")
    for method, name in METHOD_NAMES.items():
        named = F.when(key == method, name).otherwise(named)
    return F.coalesce(named, key)


def method_order(key: Column) -> Column:
    return F.when(key == PARAGRAPH_METHOD, 0).otherwise(1)


def fixed_text(value: Column, digits: int) -> Column:
    """``value`` with ``digits`` decimals, rounded by its exact binary value, ties to even.

    The product with a power of ten is taken with its rounding error (Dekker), so a value
    just beside a tie is told from the tie. Very large values have no decimals to round.
    """
    power = float(10**digits)
    high_power = power  # at most 27 bits, so its low half is zero
    spread = value * 134217729.0
    high = spread - (spread - value)
    low = value - high
    product = value * power
    error = (high * high_power - product) + low * high_power
    floor = F.floor(product).cast("double")
    part = product - floor
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (floor % 2 != 0))))
    rounded = (floor + F.when(up, 1.0).otherwise(0.0)) / power
    return F.format_string(f"%.{digits}f", F.when(F.abs(value) < 1e9, rounded).otherwise(value))


def metric_text(metric: Column, value: Column) -> Column:
    """Four decimals, one for Calinski-Harabasz, empty for null."""
    text = F.when(metric == "calinski_harabasz", fixed_text(value, 1)).otherwise(fixed_text(value, 4))
    return F.when(value.isNull(), "").otherwise(text)


def first_words(words: Column, n: int) -> Column:
    return F.array_join(F.slice(words, 1, n), ", ")


def config_label(method: Column, config_name: Column) -> Column:
    """Axis label: every word of the method and the configuration on its own line."""
    return F.concat_ws("\n", F.replace(method, F.lit(" "), F.lit("\n")), config_name)


def shown(value: Column) -> Column:
    """Text of a configuration value, ``None`` where it is missing."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def config_tag(method_key: Column, config: Column) -> Column:
    """Chart title suffix with the parameters of a configuration."""
    paragraph = F.format_string(
        "%s (dim=%s, mc=%s, ep=%s, dm=%s)", shown(config["name"]), shown(config["vector_size"]),
        shown(config["min_count"]), shown(config["epochs"]), shown(config["dm"]),
    )
    bins = F.format_string(
        "%s (bins=%s, w2v_dim=%s, w2v_mc=%s)", shown(config["name"]), shown(config["n_bins"]),
        shown(config["w2v_vector_size"]), shown(config["w2v_min_count"]),
    )
    return F.when(method_key == PARAGRAPH_METHOD, paragraph).otherwise(bins)
