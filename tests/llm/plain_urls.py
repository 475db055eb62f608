"""The URL contract in plain Python."""


def plain_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(r), r, v) for r, v in rules
            for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    if not fits:
        return host, path, None, None
    _, rule, verdict = max(fits)
    return host, path, rule, verdict
