"""Rows that several tests build on."""


def hourly(n, start=0, **columns):
    """Raw rows for hours start .. start + n - 1; callables get the hour's number."""
    rows = []
    for i in range(start, start + n):
        day, hour = divmod(i, 24)
        row = {"timestamp": f"2025-{1 + day // 28:02d}-{1 + day % 28:02d}T{hour:02d}:00"}
        rows.append(row | {k: v(i) if callable(v) else v for k, v in columns.items()})
    return rows
