"""Search in sorted arrays, and sums along arrays."""

from pyspark.sql import Column, functions as F

def count_up_to(sorted_array: Column, value: Column, most: int) -> Column:
    """How many elements of a sorted array of at most `most` are not greater than the value, by binary search."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, most.bit_length())))))
    return F.aggregate(
        steps, F.lit(0),
        lambda n, step: F.when(F.get(sorted_array, n + step - 1) <= value, n + step).otherwise(n))


def greatest_up_to(sorted_array: Column, value: Column, most: int, instead: Column | None = None) -> Column:
    """The greatest element that is not greater than the value, or the element of
    `instead` in its place; null if there is none."""
    return F.get(sorted_array if instead is None else instead, count_up_to(sorted_array, value, most) - 1)


def listed_array(values: list) -> Column:
    """A constant array of texts, as one literal of the plan."""
    texts = [str(value) for value in values]
    if not texts:
        return F.array().cast("array<string>")
    joined = "".join(texts)
    mark = next(chr(c) for c in range(0xE000, 0xF8FF) if chr(c) not in joined)
    return F.split(F.lit(mark.join(texts)), mark)


def once(value: Column, then) -> Column:
    """`then` of a value that is computed a single time, however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _prefixes(numbers: Column, chunk: int, start: Column, add) -> Column:
    """What `add` gives for an array's numbers up to and including each place, from `start` on.

    Appending to one array would copy it for every element; here that happens
    inside chunks, and once more for the chunks' totals.
    """
    none = F.array().cast("array<bigint>")

    def running(values: Column) -> Column:
        return F.aggregate(values, F.struct(start.alias("now"), none.alias("all")), lambda s, x: F.struct(
            add(s["now"], x).alias("now"), F.array_append(s["all"], add(s["now"], x)).alias("all")))

    def chunked(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / chunk).cast("int") - 1, F.lit(0)))
        return F.transform(starts, lambda c: running(F.transform(F.slice(values, c * chunk + 1, F.lit(chunk)), lambda x: x.cast("bigint"))))

    def joined(done: Column) -> Column:
        return once(running(F.transform(done, lambda d: d["now"]))["all"], lambda totals: F.flatten(F.transform(
            done, lambda d, i: once(F.coalesce(F.get(totals, i - 1), start), lambda before: F.transform(d["all"], lambda x: add(before, x))))))

    return once(numbers, lambda values: once(chunked(values), joined))


def prefix_sums(numbers: Column, chunk: int = 256) -> Column:
    """The sums of an array's numbers up to and including each place, as bigints."""
    return _prefixes(numbers, chunk, F.lit(0).cast("bigint"), lambda a, b: a + b)


def prefix_maxima(numbers: Column, chunk: int = 256) -> Column:
    """The greatest of an array's numbers up to and including each place, as bigints."""
    return _prefixes(numbers, chunk, F.lit(-(1 << 63)).cast("bigint"), lambda a, b: F.greatest(a, b))
