"""Physical plans as text."""

import re


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def main_part(df):
    """The plan without the subqueries drawn inside it."""
    lines, skip = [], None
    for line in physical(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if re.match(r"^[ :+-]*Subquery subquery", line):
            skip = depth
            continue
        lines.append(line)
    return "\n".join(lines)


def count(text, node):
    return len(re.findall(rf"^[ :+\-*()\d]*{node}\b", text, flags=re.MULTILINE))
