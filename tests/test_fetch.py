import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from millrace.plans import corpus
from millrace.sources import fetch


class Pages(BaseHTTPRequestHandler):
    def do_GET(self):
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/page")
        else:
            self.send_response(200 if self.path in ("/page", "/gbk") else 404)
        self.send_header("Content-Type", "text/html; charset=" + ("gbk" if self.path == "/gbk" else "utf-8"))
        self.end_headers()
        if self.path in ("/page", "/gbk"):
            self.wfile.write("<title>标题</title><p>Text of a page</p>".encode("gbk" if self.path == "/gbk" else "utf-8"))

    def log_message(self, *args):
        pass


def test_urls_are_fetched(spark):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    try:
        urls = [f"{at}/moved", f"{at}/gbk", f"{at}/none", "http://127.0.0.1:1/"]
        got = spark.createDataFrame(fetch.fetched(spark.createDataFrame([(u,) for u in urls], "source string")).collect(), "asked string, source string, content binary, error string")
        files, failures = fetch.split(got)
        parsed = corpus.parse(files)
        docs = {r.source_path: r.title for r in parsed.documents.collect()}
        assert docs == {f"{at}/page": "标题", f"{at}/gbk": "标题"}
        assert {r.source: r.kind for r in failures.collect()} == {f"{at}/none": "parse_error", "http://127.0.0.1:1/": "parse_error"}
        assert all(r.error.startswith(f"Failed to fetch {r.source}: ") for r in failures.collect())
        assert {r.content for r in parsed.sections.collect()} == {"标题Text of a page"}
    finally:
        server.shutdown()
