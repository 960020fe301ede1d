"""Fixed values that results depend on.

These lists must equal the rule sets of the reproduced pipeline for the
outputs to match; they are stated here plainly, in natural order, in one
place.  Everything else in the package derives from them.
"""

# --- fixed values: protocol numbers -> labels --------------------------------
# `integrated` profile: only five labels exist.
PROTOCOL_LABELS_INTEGRATED = {"6": "TCP", "17": "UDP", "1": "ICMP", "58": "ICMPv6"}
PROTOCOL_OTHER_INTEGRATED = "OTHER"

# `modular` profile: IANA names for common numbers, else "PROTO-<n>".
PROTOCOL_LABELS_MODULAR = {
    "1": "ICMP", "2": "IGMP", "6": "TCP", "17": "UDP", "41": "IPv6", "47": "GRE",
    "50": "ESP", "51": "AH", "58": "ICMPv6", "89": "OSPF", "132": "SCTP",
}
PROTOCOL_PREFIX_MODULAR = "PROTO-"

# --- fixed values: protocol whitelists ---------------------------------------
PROTOCOL_WHITELIST_INTEGRATED = ["TCP", "UDP", "ICMP", "ICMPv6", "OTHER"]
# Compared after trim + upper case, so the mixed-case IPv4/IPv6 entries can
# never match (kept as in the rule set; see README).
PROTOCOL_WHITELIST_MODULAR = [
    "TCP", "UDP", "ICMP", "IPv4", "IPv6", "ARP", "DNS", "HTTP", "HTTPS",
    "TLS", "SSL", "FTP", "SMTP", "POP3", "IMAP", "SSH", "TELNET", "SNMP",
]

# --- fixed values: relevance cascade (modular extraction) ---------------------
DNS_PORT = 53
WEB_PORTS = [80, 443, 8080, 8443]
NOISE_PORTS = [67, 68, 137, 138, 1900, 5353, 5355]
IMPORTANT_PORTS = [53, 80, 443, 8080, 8443, 21, 22, 23, 25, 110, 143, 993, 995,
                   3389, 5900, 1433, 3306, 5432, 6379, 27017]

# --- fixed values: attack signals --------------------------------------------
PORT_SCAN_MIN_DISTINCT = 10          # flagged when distinct dst ports > this
SENSITIVE_PORTS = [21, 22, 23, 25, 53, 80, 135, 139, 443, 445, 993, 995]
SUSPICIOUS_PORTS = [1337, 31337, 4444, 5555, 6666, 7777, 8080, 9999]
HIGH_PORT_ABOVE = 49152
SMALL_PACKET_BELOW = 40
LARGE_PACKET_ABOVE = 9000
SUSPICIOUS_DNS_TOKENS = ["dyndns", "no-ip", "ddns", "duckdns", "ngrok", "tor",
                         "hack", "exploit", "malware", "botnet", "c2", "cc"]
SUSPICIOUS_PATH_TOKENS = ["admin", "login", "wp-admin", "phpmyadmin", "shell",
                          "cmd.php", "eval", "exploit", ".asp", ".jsp"]

# --- fixed values: flow windows (seconds) and pseudonym length -------------------
FLOW_WINDOW_INTEGRATED_S = 60
FLOW_WINDOW_MODULAR_S = 1
PSEUDONYM_HEX_CHARS = 16

# --- fixed values: report size and service labels of the port report ----------------
REPORT_TOP_K = 10
SERVICE_LABELS = {80: "HTTP", 443: "HTTPS", 53: "DNS"}
SERVICE_OTHER = "Other"
LARGE_PACKET_BYTES = 2000
# Families of user agents, the first pattern that a lower-cased agent contains.
AGENT_FAMILIES = {
    "Bot": "bot|crawler|spider", "Command line": "^(curl|wget|python|go-http-client|libwww)",
    "Edge": "edg(e|a|ios)?/", "Opera": "opr/|opera", "Firefox": "firefox/|fxios/", "Internet Explorer": "msie |trident/",
    "Chrome": "chrome/|crios/|chromium/", "Safari": "safari/",
}
AGENT_OTHER = "Other"

# --- fixed values: timestamp zone suffixes removed by the modular validator -------
MODULAR_ZONE_SUFFIXES = [" CEST", " CET", " UTC"]

# --- fixed values: capture discovery globs -----------------------------------------
CAPTURE_GLOBS_INTEGRATED = ["*.pcap", "*.pcapng", "*.cap"]
CAPTURE_GLOBS_MODULAR = ["*.pcapng"]

# --- fixed values: text patterns and formats ---------------------------------------
# Trailing zone abbreviation removed (not applied) before parsing a capture time.
ZONE_SUFFIX_PATTERN = r"\s+[A-Z]{3,4}$"
# A dotted quad anywhere in text (address leak scan); `[.]` keeps it engine-neutral.
DOTTED_QUAD_PATTERN = r"\b[0-9]{1,3}([.][0-9]{1,3}){3}\b"
# Shape of a pseudonym.
HASH_FORMAT_PATTERN = "^[a-f0-9]{16}$"
# The modular validator's time formats (month-name, ISO, day-first, month-first;
# each with and without a fraction), written as Spark datetime patterns.
MODULAR_TIME_FORMATS = [
    "MMM d, yyyy H:m:s[.SSSSSS]",
    "yyyy-M-d H:m:s[.SSSSSS]",
    "d/M/yyyy H:m:s[.SSSSSS]",
    "M/d/yyyy H:m:s[.SSSSSS]",
]

# --- fixed values: the salt published with the reproduced pipeline -----------------
# Only for reproducing its golden pseudonyms; real runs must pass their own salt.
PUBLISHED_SALT = "cybersec_dataset_2025"

# --- fixed values: pseudonyms of known addresses under the published salt ----------
GOLDEN_SALT_FIRST = {"10.0.2.15": "7a62ce71a155f743", "192.168.1.1": "74a7aecfff460466",
                     "93.184.216.34": "80fcfbc8ef3f2d4f"}
GOLDEN_SALT_LAST = {"10.0.2.15": "4e5c743ef893bc85", "192.168.1.1": "80537bff259cc51b",
                    "93.184.216.34": "a820b354ecaf81de"}
