"""Log lines of our own, with answers worked out by hand."""

import json

# Names as a leaking host would ask for: capitals, asterisks and slashes, no words.
ENCODED = [f"x1-.{head}*{tail}/q-.payroll.zip.cdn.example.net" for head, tail in (
    ("QmFZtR7XKWPLdJ3c", "uW2kVb"), ("ZzK9pLxTGQRSm4Hv", "Ao3YNe"), ("Hj5NnBvDCFMUw8Zq", "Te8SXi")
)]
ASKING, UPSTREAM, ANSWER, UPDATER = "10.20.0.7", "192.168.7.53", "203.0.113.9", "192.168.7.4"


def dns_record(time: str, message: str, owner: str = "client01") -> dict:
    return dict(time=time, ident="dnsmasq", owner=owner, log_format="dnsmasq", pid="811", message=message)


def _exchange(time: str, name: str) -> list[dict]:
    steps = (f"query[A] {name} from {ASKING}", f"forwarded {name} to {UPSTREAM}", f"reply {name} is {ANSWER}")
    return [dns_record(time, step) for step in steps]


_LAST = "Mar 04 09:17:05"
DNS = [
    *_exchange("Mar 04 09:15:00", ENCODED[0]),
    *_exchange("Mar 04 09:15:25", ENCODED[1]),
    *_exchange("Mar 04 09:16:05", ENCODED[2]),
    dns_record(_LAST, f"query[TXT] version.example.org from {UPDATER}"),
    dns_record(_LAST, f"forwarded version.example.org to {UPSTREAM}"),
    dns_record(_LAST, "reply version.example.org is 7:41:9"),
    dns_record(_LAST, f"query[A] docs.mirror.example.net from {UPDATER}"),
]


def error_record(time: str, level: str, client: str, message: str) -> dict:
    return dict(time=time, log_format="apache_error", owner="client01", level=level, pid="902", client=client, message=message)


_SHOP = "/srv/www/shop"
_FROM_SHOP = ", referer: https://shop.example.com"
ERRORS = [
    error_record("Mar 05 08:00:01.000001 2023", "php7:warn", "10.20.0.9:40001", f"PHP Notice:  Undefined index: page in {_SHOP}/list.php on line 12"),
    error_record("Mar 05 08:00:02.000002 2023", "php7:warn", "10.20.0.9:40001", f"PHP Notice:  Undefined index: page in {_SHOP}/cart.php on line 7"),
    error_record("Mar 05 08:00:03.000003 2023", "php7:error", "198.51.100.20:50010", f"script '{_SHOP}/old.php' not found or unable to stat{_FROM_SHOP}"),
    error_record("Mar 05 08:00:04.000004 2023", "autoindex:error", "198.51.100.20:50012", f"AH01276: Cannot serve directory {_SHOP}/img/: No matching DirectoryIndex{_FROM_SHOP}"),
    error_record("Mar 05 08:00:05.000005 2023", "php7:error", "198.51.100.20:50012", f"script '{_SHOP}/test.php' not found or unable to stat{_FROM_SHOP}"),
]

ACCESS = [
    dict(host="198.51.100.20", owner="client01", log_format="apache2_access", user="-", method="GET", path=path, code="200",
         size=size, referer="-", agent="probe/1.0")
    for path, size in (("/", "512"), ("/css/site.css?v=3", "2048"))
]


def as_lines(records: list[dict]) -> list[str]:
    return [json.dumps(record) for record in records]
