"""Plain versions that more than one test uses."""


def brute_lines(rows, max_ratio, min_pages):
    """``(doc_id, text, lang, source)`` rows without the boilerplate lines of their source."""
    pages: dict = {}
    for _, text, _, source in rows:
        pages.setdefault(source, {}).setdefault(text, {line.strip(" ") for line in text.split("\n")})
    counts: dict = {}
    for source, own in pages.items():
        for lines in own.values():
            for line in lines:
                counts[source, line] = counts.get((source, line), 0) + 1
    drop = {key for key, n in counts.items() if key[1] and n >= min_pages and n > max_ratio * len(pages[key[0]])}
    return [
        (doc, "\n".join(line for line in text.split("\n") if (source, line.strip(" ")) not in drop), lang, source)
        for doc, text, lang, source in rows
    ]
