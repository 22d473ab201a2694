"""Read-only HTTP endpoints over the query service, on the standard library's server."""

from __future__ import annotations

import json
import math
from datetime import date, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import SparkSession

from wayledger.config import Settings
from wayledger.plans.serve import DEFAULT_LIMIT, Page, QueryService


def plain_value(v: Any) -> Any:
    """JSON form of a value: times as ISO text, NaN and infinity as null."""
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, float) and not math.isfinite(v):
        return None
    return v


def _items(rows: list[dict]) -> list[dict]:
    return [{k: plain_value(v) for k, v in r.items()} for r in rows]


def _page(p: Page) -> dict:
    return {"items": _items(p.items), "total": p.total, "limit": p.limit, "offset": p.offset, "returned": p.returned, "has_more": p.has_more, "next_offset": p.next_offset}


class NotFound(LookupError):
    """No such path, device or position."""


def answer(service: QueryService, target: str) -> tuple[int, dict]:
    """Status and body for a GET of ``target``."""
    url = urlsplit(target)
    path = [unquote(x) for x in url.path.strip("/").split("/")]
    q = {k: v[-1] for k, v in parse_qs(url.query, keep_blank_values=True).items()}
    try:
        return 200, _route(service, path, q)
    except NotFound as e:
        return 404, {"detail": str(e)}
    except FileNotFoundError:
        return 503, {"detail": "Products are not available."}
    except (ValueError, TypeError) as e:
        return 422, {"detail": str(e)}


def _route(service: QueryService, path: list[str], q: dict[str, str]) -> dict:
    def number(name: str, default: int) -> int:
        try:
            return int(q.get(name, default))
        except ValueError as e:
            raise ValueError(f"{name} must be an integer") from e

    span = {"start": q.get("start_date"), "end": q.get("end_date")}
    page = lambda: {"limit": number("limit", DEFAULT_LIMIT), "offset": number("offset", 0)}
    match path:
        case ["health"]:
            return {"status": "ok"}
        case ["api", "v1", "devices"]:
            return _page(service.devices(**page()))
        case ["api", "v1", "devices", device]:
            if (row := service.device(device)) is None:
                raise NotFound("Device not found.")
            return _items([row])[0]
        case ["api", "v1", "devices", device, "last-position"]:
            if (row := service.last_position(device)) is None:
                raise NotFound("Position not found.")
            return _items([row])[0]
        case ["api", "v1", "devices", device, "route"]:
            return _page(service.route(device, **span, **page()))
        case ["api", "v1", "daily-summaries"]:
            return _page(service.daily(q.get("device_serial"), **span, **page()))
        case ["api", "v1", "data-quality"]:
            return _page(service.quality(**span, **page()))
    raise NotFound("Not found.")


def make_server(spark: SparkSession, settings: Settings, port: int = 8000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that answers GET only; other origins may read if the settings name them."""
    service = QueryService(spark, settings)

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            status, body = answer(service, self.path)
            raw = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(raw)))
            origin = self.headers.get("Origin")
            if origin and origin in settings.cors_origins:
                self.send_header("Access-Control-Allow-Origin", origin)
                self.send_header("Vary", "Origin")
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
