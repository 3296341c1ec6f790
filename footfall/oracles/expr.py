"""SQL fragments."""


def u(cols: str, salt: str) -> str:
    digits = f"substr(md5(concat_ws('|', {cols}, 'footfall-{salt}')), 1, 8)"
    return f"(cast('0x' || {digits} AS bigint) / 4294967296::double)"


def jit(low: float, cols: str, salt: str) -> str:
    return f"({low}::double + {round(1 - low, 6)}::double * {u(cols, salt)})"


#: Marks the condition of a row sample, so that ``sql`` can leave the sampling out.
SAMPLE = "/* sample */"


def sample(cols: str, salt: str, drop: float) -> str:
    return f"{u(cols, salt)} > {drop} {SAMPLE}"


def top(source: str, keys: str, k: int, order: str, cols: str) -> str:
    return f"""
    SELECT {cols} FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}
    ) WHERE rn <= {k}"""


def rk(score: str) -> str:
    return f"floor({score} * 1e6 + 0.5) DESC"
