"""On-chain constants, output categories and default settings.

These have to equal what upstream systems and downstream consumers use, so they
are spelled out here and nowhere else.
"""

# --- on-chain values -------------------------------------------------------
ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"
TRANSFER_EVENT = "Transfer"
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TRANSFER_SIGNATURE = "Transfer(address,address,uint256)"
APPROVAL_TOPIC = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
APPROVAL_SIGNATURE = "Approval(address,address,uint256)"
DEFAULT_TOKEN_DECIMALS = 18
MAX_PLAUSIBLE_BLOCK = 999_999_999
ADDRESS_LENGTH = 42

# --- event categories ------------------------------------------------------
EVENT_CATEGORIES = [
    "token_transfer",
    "token_approval",
    "access_control",
    "contract_upgrade",
    "auction",
    "rebalancing",
    "other",
]
ACCESS_CONTROL_EVENTS = ["RoleGranted", "RoleRevoked", "RoleAdminChanged"]
CONTRACT_UPGRADE_EVENTS = ["Upgraded", "AdminChanged", "Initialized"]
AUCTION_PREFIX = "Auction"
REBALANCE_PREFIX = "Rebalance"

# --- text lengths of the signature catalog ---------------------------------
TOPIC_LENGTH = 66
EVENT_NAME_LENGTH = 100
SIGNATURE_LENGTH = 255

# --- speed layer -----------------------------------------------------------
ALERT_THRESHOLD_TOKENS = 10_000_000
DRAIN_SECONDS = 300
POLL_LIMIT = 100_000

# --- documents -------------------------------------------------------------
CHUNK_SIZE = 3500
CHUNK_OVERLAP = 700
CHARS_PER_OVERLAP_WORD = 5
PARAGRAPH_SEPARATOR = "\n\n"
EMBED_BATCH = 10
SEARCH_LIMIT = 5

# The characters that Python's ``str.isspace`` accepts, as a Java regex class
# and as plain text for ``btrim``. The class puts single Latin-1 characters first
# and the rest behind one range test, which makes it twice as fast on text.
SPACE_CLASS = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
