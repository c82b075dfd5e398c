"""Fixed values of the domain: words, patterns, tables and weights that results depend on."""

from __future__ import annotations

# --- Fixed values: sentences that state a requirement ---
NORMATIVE = (
    r"(?i)\b(shall(?:\s+not)?|must(?:\s+not)?|required\s+to|is\s+required|is\s+prohibited|prohibited\s+from|is\s+mandatory|mandated"
    r"|only\s+if|valid\s+only\s+when|invalid\s+if|shall\s+return|shall\s+send|shall\s+set|shall\s+clear|shall\s+reject|shall\s+accept"
    r"|shall\s+stop|shall\s+terminate|stops|terminates|rejects|accepts|returns|sent|not\s+sent)\b"
)

# --- Fixed values: signals of requirement types, in the order in which they are listed ---
SIGNALS = {
    "timing_bound": (
        r"(?i)\b(within\s+\d+\s*(ms|milliseconds?|seconds?|minutes?|hours?)|after\s+\d+\s*(ms|milliseconds?|seconds?|minutes?|hours?)"
        r"|before\s+\d+\s*(ms|milliseconds?|seconds?|minutes?|hours?)|no\s+(?:more|less)\s+than\s+\d+\s*(ms|milliseconds?|seconds?)"
        r"|deadline|expir(?:y|ation)|timeout|latency\s+requirement|time\s+limit|periodic(?:ally)?|retry\s+interval|\d+\s*(?:ms|s|sec|seconds?))\b"
    ),
    "state_transition": (
        r"(?i)\b(transition\s+(?:to|from)|shall\s+enter|shall\s+exit|move\s+to\s+state|change\s+(?:state|to)|set\s+to|cleared?\s+to"
        r"|become\s+(?:active|inactive)|go(?:es)?\s+to|leaves?\s+state|initial(?:ize|ise)|startup\s+state|default\s+state)\b"
    ),
    "conditional_if": (
        r"(?is)(if\b.{0,150}(?:then|shall)\b|when\b.{0,150}shall\b|upon\s+receipt(?:\s+of)?|in\s+response\s+to|as\s+a\s+result\s+of"
        r"|only\s+when|valid\s+only\s+when|only\s+if|invalid\s+if|conditioned\s+on|provided\s+that|given\s+that|if\b[^,\n]{0,100},\s*\w)\b"
    ),
    "lifecycle_keyword": (
        r"(?i)\b(on\s+startup|on\s+power(?:\s+up)?|initialization|power-up|boot(?:ing)?|reset|factory\s+reset|on\s+reboot|power\s+loss|recommission"
        r"|re-provisioning|join(?:ing)?\s+fabric|leave\s+fabric)\b"
    ),
    "protocol_keyword": (
        r"(?i)\b(fabric|commissioning|subscription|report(?:ing)?|discovery|pairing|attestation|operational\s+credentials?"
        r"|ble|bluetooth\s+low\s+energy|dns-sd|mdns|qr\s+(?:code)?|nfc|discriminator|passcode|setup\s+code|vendor\s+id|product\s+id"
        r"|csr|nocsr|noc|icac|rcac|dac|pai|paa|matter\s+(?:fabric|network|device|controller|commissioner)|cluster\s+revision|feature\s+map)\b"
    ),
    "entity_definition": (
        r"(?i)\b(indicates?\s+(?:the|a|whether|if|how|when|that)\b|represents?\s+(?:the|a|whether|an)\b|is\s+defined\s+as\b"
        r"|describes?\s+(?:the|a|how|whether)\b|specifies?\s+(?:the|a|how|whether|which)\b|contains?\s+the\s+current\b|stores?\s+(?:the|a|current)\b"
        r"|holds?\s+(?:the|a|current)\b|identifies?\s+(?:the|a|an)\b|reports?\s+(?:the|a|current|an)\b|reflects?\s+(?:the|a)\b|is\s+the\s+current\b"
        r"|provides?\s+(?:the|a|an)\b|data\s+type\s+(?:is|shall\s+be)\b|attribute\s+type\b|type\s+of\s+the\b)\b"
    ),
    "value_constraint_pattern": (
        r"(?i)(?:\bin\s+the\s+range\b|\bshall\s+be\s+(?:in|within|between)\b|\bminimum\s+(?:value|of|is)\b|\bmaximum\s+(?:value|of|is)\b|\bvalid\s+values?\b"
        r"|\bshall\s+not\s+exceed\b|\bshall\s+be\s+(?:at\s+(?:least|most)|no\s+(?:less|more)\s+than)\b|\bdefault\s+(?:value|shall\s+be)\b|\bdefault\s+is\b"
        r"|\brange\s+(?:of|is|shall\s+be)\b|\blower\s+bound\b|\bupper\s+bound\b|\ballowed\s+values?\b|\bconstrained\s+to\b|\bdata\s+type\s+shall\s+be\b"
        r"|\b\d+\s+to\s+\d+(?:\s+inclusive)?\b|0x[0-9a-fA-F]+\s+to\s+0x[0-9a-fA-F]+)"
    ),
    "cross_entity_dep": (
        r"(?i)\b(depend(?:s|ing)?\s+on|requires\s+.*\s+(?:cluster|attribute|command)|is\s+linked\s+to|ties?\s+to|cascades?\s+to|propagates?\s+to"
        r"|corresponds?\s+to|coupled\s+(?:with|to))\b"
    ),
}

# --- Fixed values: requirement types with their signal and weight, in the order that settles ties; what raises a type ---
TYPES = {
    "timing_requirement": ("timing_bound", 4.0),
    "state_transition_rule": ("state_transition", 3.5),
    "entity_definition_changed": ("entity_definition", 3.5),
    "value_constraint": ("value_constraint_pattern", 3.5),
    "conditional_behavior_rule": ("conditional_if", 3.0),
    "cross_entity_dependency": ("cross_entity_dep", 2.0),
}
BASELINE = ("general_normative", 1.0)
BOOSTS = (
    (("timing_bound", "protocol_keyword"), "timing_requirement", 0.5),
    (("timing_bound", "conditional_if"), "timing_requirement", 1.0),
    (("lifecycle_keyword",), "state_transition_rule", 1.0),
    (("value_constraint_pattern", "entity_definition"), "value_constraint", 0.5),
)
CERTAIN, LEAST_CONFIDENCE = 0.70, 0.30

# --- Fixed values: clauses of a requirement ---
CONDITION_CLAUSE = r"(?i)(?:if|when|upon\s+receipt(?:\s+of)?|in\s+response\s+to|only\s+when|only\s+if|valid\s+only\s+when|invalid\s+if)\s+([^,\.;]{3,140})"
EFFECT_CLAUSE = r"(?i)(?:shall|must)\s+([^,\.;]{3,140})"
CONSTRAINT_CLAUSE = (
    r"(?i)(\b(?:between|in\s+the\s+range\s+of?|from|no\s+more\s+than|no\s+less\s+than|at\s+most|at\s+least|greater\s+than|less\s+than|equal\s+to|one\s+of"
    r"|enum(?:erated)?|in\s+the\s+set\s+of)\b[^\.;]{2,120})"
)

# --- Fixed values: what rejects a candidate sentence ---
LEAST_LENGTH, LEAST_WORDS = 30, 4
GLOSSARY_ROW = r"(?i)^\s*\w[\w\s/\-]{0,40}\|\s*(?:[Aa]\s+key\s+word|[Aa]\s+term|normative|informative|indicates?\s+that|is\s+used|means?\s+that)"
TABLE_ROW = r"^[^|]{0,80}\|[^|]{1,80}\|[^|]{1,80}"
STARTS_MODAL = r"(?i)^\s*(shall|must|should|may)\b"
SECTION_NUMBER = r"^\s*[\d]+(?:\.[\d]+)*\.?\s*"
CONFORMANCE_CELL = r"(?i)^\s*(M|O|P|D|C\[[^\]]{1,60}\]|desc|feature\s+[A-Z])\s*[|,]"
NUMERIC_ROW = r"^\s*\d{1,3}\s*\|"
STARTS_LOWER = r"^[a-z][a-z0-9_\-]*\b"
MODAL = r"(?i)\b(shall|must|should|may)\b"
OPEN_END = r"(?i)\b(that|which|and|or|but|as|if|when|where|whose|of|in|a|an|the|with|by|to|for|from)\s*[,.]?\s*$"
FIELD_DEFINITION = (
    r"(?i)^(?:This|The)\s+(?:attribute|field|command|event|cluster|value|entry)\s+(?:SHALL|MUST)\s+"
    r"(?:indicate|contain|represent|be\s+set\s+to|show|provide|identify|specify)\b"
)
NORMATIVE_WORD = r"(?i)\b(shall|must|should|may|mandatory|required|prohibited|forbidden)\b"

# --- Fixed values: test intents in their order ---
INTENTS = {
    "read_attribute": r"(?i)\b(read(?:ing)?\s+(?:the\s+)?(?:attribute|value)|TH\s+reads?|DUT\s+reads?|verify\s+(?:that\s+)?attribute)\b",
    "write_attribute": r"(?i)\b(write(?:s|ing)?\s+(?:the\s+)?(?:attribute|value)|TH\s+writes?|DUT\s+writes?|set(?:s|ting)?\s+attribute)\b",
    "invoke_command": r"(?i)\b(send(?:s|ing)?\s+(?:a\s+)?(?:command|request)|invoke(?:s|d|ing)?\s+(?:the\s+)?command|TH\s+sends?|DUT\s+sends?)\b",
    "validate_response": (
        r"(?i)\b(verify(?:ing)?\s+(?:the\s+)?response|check(?:ing)?\s+(?:the\s+)?response|assert(?:s|ing)?\s+(?:the\s+)?response"
        r"|response\s+(?:is|shall\s+be|contains?))\b"
    ),
    "validate_error": (
        r"(?i)\b((?:verify|check|expect)\s+(?:an?\s+)?error|error\s+(?:code|response|status)"
        r"|status\s+(?:code\s+)?(?:UNSUPPORTED|INVALID|FAILURE|NOT_FOUND|CONSTRAINT_ERROR|ACCESS_DENIED)"
        r"|shall\s+(?:return|respond\s+with)\s+(?:FAILURE|UNSUPPORTED|INVALID|ERROR))\b"
    ),
    "observe_event": (
        r"(?i)\b(event(?:s)?\s+(?:is|are|shall|generated|triggered|emitted)|verify(?:ing)?\s+(?:the\s+)?event|check(?:ing)?\s+(?:the\s+)?event"
        r"|subscribe\s+to\s+event|event\s+subscription)\b"
    ),
    "validate_timing": (
        r"(?i)\b(within\s+\d+\s*(ms|seconds?|minutes?)|timeout|latency|deadline|after\s+\d+\s*(ms|seconds?)|periodic(?:ally)?"
        r"|timing\s+(?:requirement|constraint))\b"
    ),
    "validate_state_transition": (
        r"(?i)\b(state\s+(?:transition|change)|transition\s+(?:to|from)\s+(?:state\s+)?\w+|verify(?:ing)?\s+(?:the\s+)?state"
        r"|check\s+(?:the\s+)?(?:new\s+)?state)\b"
    ),
    "validate_cross_entity_dependency": (
        r"(?is)\b(dependency|another\s+(?:cluster|attribute|command)|multiple\s+(?:clusters?|attributes?|commands?)"
        r"|cluster\s+\w+.*cluster\s+\w+|attribute\s+\w+.*attribute\s+\w+)\b"
    ),
    "validate_commissioning_flow": r"(?i)\b(commission(?:ing|ed)?|provisioning|attestation|operational\s+credentials?|NOC|ICAC|RCAC|CSR|DAC|PAI|PAA)\b",
    "validate_discovery_behavior": r"(?i)\b(discover(?:y|ed|able)?|dns-sd|mdns|announce(?:ment)?|advertis(?:e|ing|ement)|browse\s+for|resolve\s+service)\b",
    "validate_onboarding_payload": (
        r"(?i)\b(QR\s+code|manual\s+entry\s+code|setup\s+(?:code|payload)|discriminator|passcode|vendor\s+id|product\s+id|NFC\s+tag)\b"
    ),
    "validate_behavior_rule": (
        r"(?i)\b(behavior|conformance|PICS|PICSMAP|shall\s+(?:not\s+)?(?:support|implement|expose)|mandatory\s+(?:attribute|command|feature|cluster))\b"
    ),
    "negative_scenario": (
        r"(?i)\b(negative|invalid\s+(?:input|value|request|command)|out(?:\s+of|\s*-\s*)range|unsupported|reject(?:ed|s|ing)?|exceed(?:s|ing)?"
        r"|malformed|forbidden|unauthorized|beyond\s+(?:max|maximum)|below\s+(?:min|minimum))\b"
    ),
}

# --- Fixed values: edges of a test by intent, the entity types that an intent suits (others suit all), edges by entity type ---
INTENT_EDGES = {
    "read_attribute": "reads",
    "write_attribute": "writes",
    "invoke_command": "tests_command",
    "validate_response": "verifies_attribute",
    "validate_error": "negative_tests",
    "observe_event": "observes_event",
    "validate_timing": "verifies_rule",
    "validate_state_transition": "verifies_rule",
    "validate_cross_entity_dependency": "depends_on",
    "validate_commissioning_flow": "in_context",
    "validate_discovery_behavior": "in_context",
    "validate_onboarding_payload": "in_context",
    "validate_behavior_rule": "verifies_rule",
    "negative_scenario": "negative_tests",
}
INTENT_SUITS = {
    "read_attribute": ("attribute",),
    "write_attribute": ("attribute",),
    "invoke_command": ("command",),
    "validate_error": ("command", "attribute"),
    "observe_event": ("event",),
    "validate_response": ("attribute", "command"),
    "negative_scenario": ("command", "attribute", "event"),
}
TYPE_EDGES = {"attribute": "verifies_attribute", "command": "tests_command", "event": "observes_event", "feature": "verifies_rule", "cluster": "tests"}
VALIDATION_EDGES = {
    "validates_type": r"(?i)\bdata.?type\b|\btype\s+is\b|\btype\s+of\b|\bdata\s+type\b",
    "validates_range": r"(?i)\brange\b|\bmin(?:imum)?\b|\bmax(?:imum)?\b|\bbound(?:ary)?\b",
    "validates_default": r"(?i)\bdefault\b",
    "validates_quieter_reporting": r"(?i)\bnull(?:able)?\b",
    "validates_enum": r"(?i)\benum\b|\benumerat\w+\b",
    "validates_access": r"(?i)\baccess\b|\bACL\b|\bAdmin\b|\bView\b|\bOperate\b",
    "validates_conformance": r"(?i)\bconform(?:ance)?\b|\bPICS\b|\bfeature\s+map\b",
}
GATE = r"(?i)\bPICS(?:MAP)?\s*[:=]?\s*([A-Z][A-Z0-9_]+(?:\.[A-Z0-9][A-Z0-9_]*)+)"

# --- Fixed values: named behaviours and protocol anchors ---
BEHAVIOURS = {
    "Power_Cycling": r"(?i)\b(power(?:ed)?\s+(?:off|on|cycle|cycling)|power-cycling)\b",
    "BLE_Advertisement": r"(?i)\b(ble\s+advert|bluetooth.*advert|advert(?:ise|ising|isement))\b",
    "Device_Discovery": r"(?i)\b(device\s+discov|dns-sd|mdns|discoverability)\b",
    "Commissioning_Mode_Entry": r"(?i)\b(commissioning\s+mode|enter.*commissioning|open.*commissioning)\b",
    "Commissioning_Flow": r"(?i)\b(commissioning\s+(?:flow|process|procedure|step))\b",
    "Device_Blinking": r"(?i)\b(blink(?:ing|s)?)\b",
    "Device_Reset": r"(?i)\b(factory\s+reset|hard\s+reset|reboot|power\s+loss)\b",
    "Subscription_Reporting": r"(?i)\b(subscription|report\s+interval|min\s+interval|max\s+interval)\b",
    "Fabric_Join": r"(?i)\b(join(?:ing)?\s+fabric|add(?:ed)?\s+to\s+fabric)\b",
    "IPv4_Tolerance": r"(?i)\b(ipv4\s+(?:coexistence|tolerance|traffic)|ipv4)\b",
}
ANCHORS = {
    "PROTO::BLE": r"(?i)\b(ble|bluetooth\s+low\s+energy|bt\s+le)\b",
    "PROTO::Commissioning": r"(?i)\b(commission(?:ing|ed)?)\b",
    "PROTO::DNS-SD": r"(?i)\b(dns-sd|mdns|multicast\s+dns)\b",
    "PROTO::QRCode": r"(?i)\b(qr\s+code|setup\s+(?:code|payload)|manual\s+entry\s+code)\b",
    "PROTO::NFC": r"(?i)\b(nfc\s+tag?|near\s+field\s+communication)\b",
    "PROTO::Discriminator": r"(?i)\b(discriminator)\b",
    "PROTO::Passcode": r"(?i)\b(passcode|setup\s+pin)\b",
    "PROTO::OperationalCreds": r"(?i)\b(noc|icac|rcac|csr|nocsr|operational\s+credentials?)\b",
    "PROTO::Attestation": r"(?i)\b(attestation|dac|pai|paa|device\s+attestation)\b",
    "PROTO::Subscription": r"(?i)\b(subscription|reporting|subscribe(?:d)?|report\s+interval)\b",
    "PROTO::Fabric": r"(?i)\b(fabric|multi-fabric)\b",
    "PROTO::Discovery": r"(?i)\b(discover(?:y|ed|able)?|advertis(?:e|ing|ement))\b",
}

# --- Fixed values: modes of a test case ---
PROTOCOL_PREFIXES = ("IDM", "SC", "BDX", "DD", "DA", "ACE", "MC", "JFADMIN", "JF", "MCORE", "DT", "SU")
CLUSTER_MODE = (
    r"(?i)\b(attribute(?:s)?|command(?:s)?|event(?:s)?|feature(?:\s+map)?|cluster|DUT\s+(?:reads?|writes?|sends?|receives?)"
    r"|verify(?:ing)?\s+(?:attribute|command|event)|read\s+attribute|write\s+attribute|invoke\s+command)\b"
)
PROTOCOL_MODE = (
    r"(?i)\b(commission(?:ing|ed)?|subscription|report(?:ing)?|discovery|ble|dns-sd|mdns|fabric|attestation|noc|icac|rcac|dac|pai|paa"
    r"|passcode|discriminator|setup\s+code|qr\s+code|nfc|onboarding|pairing|operational\s+credentials?"
    r"|invoke\s+request|read\s+request|write\s+request|timed\s+request|batched\s+command|interaction\s+model|chunked\s+message"
    r"|case\s+session|pase\s+session|sigma|mrp|tcp\s+connection|bulk\s+data|bdx\s+transfer|access\s+control\s+entr|subject\s+descriptor|privilege)\b"
)
MODE_HIGH, MODE_LOW = 0.65, 0.35

# --- Fixed values: which entity names may be matched; letters from which they may be matched in another cluster ---
BLOCKED = tuple(
    "step description condition action expected type state mode status other order user basic start end stop next move auto open close delay pause "
    "previous extended messages application supported enabled fault energy count duration on off".split()
)
NEEDS_CLUSTER = tuple(
    "acl arl audio bssid boost fair leave level lift latch login maps mask nocs offer onoff panid play power rfid rssi radar reset rinse scale seek "
    "sleep speed spin tilt video".split()
)
FREE_LENGTH, UNIQUE_LENGTH = 10, 7

# --- Fixed values: weights of the re-ranking signals; scores of chunk types ---
WEIGHTS = {
    "entity": 0.25, "cluster": 0.15, "condition": 0.15, "intent": 0.15, "direct": 0.20, "indirect": 0.08, "lexical": 0.08, "chunk": 0.05, "retrieval": 0.04,
}
CHUNK_SCORES = {
    "intent_summary": 1.00, "behavior_rule": 0.90, "state_transition": 0.85, "timing_requirement": 0.85, "requirement": 0.80, "test_step": 0.60,
    "prerequisite": 0.50, "setup": 0.40, "teardown": 0.20,
}
OTHER_CHUNK = 0.50

# --- Fixed values: test intents that matter to a kind of change ---
UNIVERSAL_INTENTS = ("validate_schema", "validate_conformance")
CHANGE_INTENTS = {
    "ADD_ATTRIBUTE": ("validate_attribute_existence", "validate_attribute_value", "validate_schema"),
    "REMOVE_ATTRIBUTE": ("validate_attribute_existence", "validate_schema"),
    "MODIFY_ATTRIBUTE": ("validate_attribute_value", "validate_conformance", "validate_access", "validate_attribute_existence"),
    "ADD_COMMAND": ("validate_command_support", "invoke_command", "validate_schema"),
    "REMOVE_COMMAND": ("validate_command_support", "validate_schema"),
    "MODIFY_COMMAND": ("validate_command_behavior", "invoke_command", "validate_command_support"),
    "ADD_EVENT": ("observe_event", "validate_event_generation", "validate_schema"),
    "REMOVE_EVENT": ("observe_event", "validate_event_generation"),
    "MODIFY_EVENT": ("observe_event", "validate_event_generation", "validate_behavior_rule"),
    "ADD_FEATURE": ("validate_feature_conformance", "validate_feature_behavior"),
    "REMOVE_FEATURE": ("validate_feature_conformance", "validate_schema"),
    "MODIFY_FEATURE": ("validate_feature_conformance", "validate_feature_behavior"),
    "ADD_REQUIREMENT": ("validate_behavior_rule", "validate_conformance", "validate_state_transition"),
    "REMOVE_REQUIREMENT": ("validate_behavior_rule", "validate_conformance"),
    "MODIFY_REQUIREMENT": ("validate_behavior_rule", "validate_conformance", "validate_state_transition"),
    "MODIFY_BEHAVIOR": ("validate_behavior_rule", "validate_state_transition", "observe_event"),
    "MODIFY_PROTOCOL": ("validate_commissioning", "validate_discovery", "validate_timing", "validate_ble", "validate_advertisement"),
    "ADD_CLUSTER": ("validate_cluster_existence", "validate_schema"),
    "REMOVE_CLUSTER": ("validate_cluster_existence",),
    "MODIFY_CLUSTER": ("validate_schema", "validate_cluster_behavior"),
    "conditional_behavior_rule": ("validate_behavior_rule", "validate_state_transition", "observe_event"),
}
BEHAVIOURAL_KINDS = (
    "MODIFY_BEHAVIOR", "ADD_REQUIREMENT", "MODIFY_REQUIREMENT", "REMOVE_REQUIREMENT", "MODIFY_EVENT", "ADD_EVENT", "conditional_behavior_rule",
)
BEHAVIOURAL_INTENTS = ("validate_behavior_rule", "validate_state_transition", "observe_event")

# --- Fixed values: words of timing and discovery, and stop words ---
TIMING_WORDS = tuple(
    "timeout timing delay ms millisecond second interval advertisement window backoff retry period duration discovery commissioning ble onboarding "
    "payload broadcast keepalive heartbeat schedule deadline".split()
)
STOP_WORDS = tuple(
    "a an the and or but in on at to for of with by from is are was were be been has have had do does did will would should shall may might can could "
    "not no nor so yet if as its it this that these those then than when where which who how what all each any both some such own same other only "
    "also just".split()
)
KEYWORD_STOP = tuple(
    "the a an is are was were be been being have has had do does did will would shall should may might must can could not no in on at to for of and or "
    "but with that this it its if when after before then sent set clear reject accept return terminate device node cluster attribute command event which "
    "such each all any some per via from by as into out up only".split()
)

# --- Fixed values: words that don't link a test case to a section ---
SECTION_STOP = tuple(
    "attribute attributes command commands event events feature features cluster clusters field fields type types table overview general introduction "
    "description specification requirements behavior protocol message messages data model section struct".split()
)
TEXT_STOP = tuple(
    "shall must should that this from with when then have been will were they them their there these those what which where each every verify check reads "
    "read write writes sends send step steps test following value values".split()
)
KIND_WORDS = ("attribute", "command", "event", "feature", "field", "struct", "enum", "bitmap")
STEP_NAME = r"(?i)(?:reads?|writes?|sends?|subscribes?\s+to|verifies?|checks?)\s+(?:a\s+|the\s+|an\s+)?([A-Z][A-Za-z0-9]+(?:[A-Z][a-z0-9]+)*)"
CODE_NAME = r"(?i)[A-Z]+\.S\.[ACE][0-9a-f]+\(([A-Za-z]+)\)"

# --- Fixed values: protocol areas of test prefixes ---
AREA_OF_PREFIX = {
    "IDM": "Interaction_Data_Model", "SC": "Secure_Channel", "BDX": "Bulk_Data_Exchange", "DD": "Device_Discovery", "DA": "Device_Attestation",
    "ACE": "Access_Control", "MC": "Multicast", "JFADMIN": "Joining_Fabric_Administrator", "JF": "Joining_Fabric_Administrator", "MCORE": "Matter_Core",
    "DT": "Descriptor", "SU": "Software_Update", "BR": "Bridged_Device", "SM": "Scene_Management", "RR": "Reachability", "ICDB": "ICD_Management",
    "WEBRTC": "WebRTC_Transport", "PAVSTI": "Push_AV_Stream_Transport_Interop",
}

# --- Fixed values: references between sections, and how many a section has at most ---
SECTION_REFERENCE = r"(?:(?:[Ss]ee|[Ss]ection|[Cc]lause|[Rr]efer(?:\s+to)?)\s+)(\d+(?:\.\d+)+)"
MOST_REFERENCES, SECTION_TEXT = 10, 6000

# --- Fixed values: edges by which a test covers something; edges that a kind of change asks for; edges that only hint ---
COVER_EDGES = ("covers", "tests", "validates", "implements", "verifies_requirement", "tests_command", "verifies_attribute", "observes_event", "verifies_rule")
READING_EDGES = ("reads", "writes", "negative_tests", *VALIDATION_EDGES)
CHANGE_EDGES = {
    "datatype_changed": ("reads", "writes", "validates_type", "verifies_attribute"),
    "constraint_changed": ("validates_range", "reads", "negative_tests"),
    "default_changed": ("validates_default", "reads"),
    "quieter_reporting_changed": ("validates_quieter_reporting", "reads", "negative_tests"),
    "enum_changed": ("validates_enum", "reads", "writes", "negative_tests"),
    "access_changed": ("validates_access", "negative_tests"),
    "conformance_changed": ("validates_conformance", "verifies_rule"),
    "behavior_changed": ("verifies_rule", "verifies_requirement", "tests_command"),
    "dependency_changed": ("depends_on", "in_context"),
    "state_machine_changed": ("verifies_rule", "verifies_requirement"),
}
BROAD_EDGES = ("tests", "covers", "validates", "implements")

# --- Fixed values: codes of the protocol-implementation statement ---
CODE = r"\b([A-Z][A-Z0-9]{0,15})\.([SC])\.([ACEF])([0-9a-fA-F]{2,4})"
CODE_KINDS = {"A": "attribute", "C": "command", "E": "event", "F": "feature"}

# --- Fixed values: sizes of vector chunks ---
CHUNK_CHARS = 1450

# --- Fixed values: sections of a diff that are never reported; a reference that was only renumbered ---
SKIPPED_TITLES = r"(?i)revision history|copyright|disclaimer|table of contents|introduction"
RENUMBERED = r"\[CHANGED:\s*\[\d+(?:\.\d+)+\]\s*→\s*\[\d+(?:\.\d+)+\]\]"
TITLE_NUMBER = r"^\d+(?:\.\d+)*\.\s*"

# --- Fixed values: the heading words of a test case's parts in AsciiDoc ---
PARTS = {
    "purpose": "purpose",
    "description": "purpose",
    "pics": "pics",
    "preconditions": "preconditions",
    "precondition": "preconditions",
    "test environment": "preconditions",
    "test preconditions": "preconditions",
    "required devices": "required_devices",
    "required device": "required_devices",
    "devices": "required_devices",
    "device topology": "device_topology",
    "topology": "device_topology",
    "setup": "test_setup",
    "test setup": "test_setup",
    "test procedure": "test_steps",
    "test procedure steps": "test_steps",
    "test steps": "test_steps",
    "test step": "test_steps",
    "procedure": "test_steps",
    "steps": "test_steps",
    "expected results": "expected_results",
    "expected result": "expected_results",
    "notes": "notes",
    "note": "notes",
}

# --- Fixed values: words that are no names of changed entities; quality letters; what a changed cell looks like ---
NO_NAMES = tuple(
    "SHALL MUST MAY SHOULD NOT NULL TRUE FALSE OPTIONAL MANDATORY PROVISIONAL DEPRECATED DISALLOWED STRUCT ENUM BITMAP ARRAY LIST OCTSTR STRING "
    "BOOLEAN UINT INT SINGLE DOUBLE TEMPERATURE Read Write Fabric Timed Admin Operate View Server Client Cluster Attribute Command Event Feature".split()
)
NO_ATTRIBUTES = tuple(
    "specifies can shall must may will would should indicates is has contains defines represents provides describes stores holds returns reports value type "
    "access conformance constraint quality default field list set table entry row".split()
)
QUALITIES = {"Q": "Quieter Reporting", "N": "Non-volatile", "P": "Fixed", "S": "Scene", "X": "Fixed-by-manufacturer", "C": "Changed-omitted"}
DATATYPE = (
    r"uint\d+|int\d+|bool(?:ean)?|string|octstr|list|struct|enum\d+|bitmap\d+|single|double|epoch-us|epoch-s|utc|posix-ms|systime-us|temperature"
)
CELL_CHANGES = {
    "conformance": r"\[CHANGED:\s*([MOPDX](?:\s*,\s*[MOPDX])*|\[[A-Z]+\])\s*→\s*([MOPDX](?:\s*,\s*[MOPDX])*|\[[A-Z]+\])\s*\]",
    "access": r"\[CHANGED:\s*([RWFVMAT]+(?:\s+[RWFVMAT]+)*)\s*→\s*([RWFVMAT]+(?:\s+[RWFVMAT]+)*)\s*\]",
    "type": rf"(?i)\[CHANGED:\s*({DATATYPE})\s*→\s*({DATATYPE})\s*\]",
    "default/fallback": r"(?i)\[CHANGED:\s*(TRUE|FALSE|null|\d+(?:\.\d+)?)\s*→\s*(TRUE|FALSE|null|\d+(?:\.\d+)?)\s*\]",
}
#: What is added for each thing that a change names, and from which confidence a change is settled.
CONFIDENCE = {"base": 0.5, "cluster": 0.1, "entities": 0.15, "conditions": 0.1, "marks": 0.15}
SETTLED, CELL_CONFIDENCE = 0.6, 0.85

# --- Fixed values: words of step actions ---
TRIVIAL = tuple("th dut the a an to of and or is are be in on at by if it as for from that this with its not no so".split())
STEP_TERMS = tuple(
    "ble bluetooth mdns wifi wi-fi thread ipv4 ipv6 tcp udp ip dns nfc qr qrcode commissioning joiner commissioner operational fabric attestation onboarding "
    "pairing discriminator passcode timer timeout expiry expiration heartbeat subscription broadcast multicast unicast discovery advertisement advertising "
    "scanning joining rejoining setupcode ssid password dataset".split()
)
NO_ACRONYMS = ("DUT", "TH", "THE", "AND", "FOR", "NOT")

#: Names that stand for too much to search a graph by.
GENERIC_NAMES = tuple("matter end start new old value type data field state mode status list set the and for with from this that".split())

#: Words in headings by which chunks of a protocol chapter are known, by the name that stands for the chapter.
CHAPTER_WORDS = {
    "virtualcluster-sc": ("secure channel",),
    "virtualcluster-idm": ("interaction model", "interaction data model"),
    "virtualcluster-bdx": ("bulk data exchange",),
    "virtualcluster-dd": ("commissioning", "device discovery"),
    "virtualcluster-da": ("device attestation",),
    "virtualcluster-ace": ("access control enforcement",),
    "virtualcluster-mc": ("multicast",),
    "virtualcluster-jf": ("joining fabric",),
    "virtualcluster-jfadmin": ("joining fabric administrator",),
    "virtualcluster-su": ("software update", "ota software update"),
    "virtualcluster-rr": ("minimal resource requirements",),
    "virtualcluster-gc": ("groupcast", "group communication"),
    "virtualcluster-br": ("bridged device test plan",),
    "virtualcluster-webrtc": ("webrtc transport test plan",),
    "virtualcluster-pavsti": ("push av stream transport interop", "push av stream transport test plan"),
    "virtualcluster-dt": ("device types test plan",),
    "virtualcluster-sm": ("system model test plan",),
}

# Titles that are no content, roles of a test case's sub-sections, and patterns of specification HTML.
SECTION_NUMBER = r"^\s*[\d]+(?:\.[\d]+)*\.?\s*"
BOILERPLATE_TITLE = (
    r"copyright|disclaimer|notice of use|license|revision history|table of contents|list of tables|list of figures"
    r"|\btoc\b|participants|acronyms\s+and\s+abbreviations|abbreviations|definitions"
)
CHROME_IDS = ("header", "footer", "toc", "toctitle", "preamble")
NOTE_CLASSES = ("admonitionblock", "note", "important", "warning", "tip", "caution")
CSS_NOISE = r"(?:[a-zA-Z-]+:[^;{}\n]{2,80}[;{}]|%7C[A-Za-z+]|family=[A-Za-z+%:]|data:[a-z]+/[a-z]+;base64,)"
CASE_HEADING = r"\[TC-[A-Z0-9_]+-[\d.]+\]?"
CASE_ID = r"\[?(TC-[A-Z0-9_]+-[\d.]+)\]?"
CASE_NUMBER = r"\bTC-([A-Z][A-Z0-9]*)-(\d+)\.(\d+)\b"
CASE_ROLES = {
    "purpose": "purpose",
    "pics": "pics",
    "pixit": "pixit",
    "preconditions": "preconditions",
    "precondition": "preconditions",
    "required devices": "required_devices",
    "required device": "required_devices",
    "device topology": "device_topology",
    "test setup": "test_setup",
    "setup": "test_setup",
    "test procedure": "test_procedure",
    "procedure": "test_procedure",
    "notes": "notes",
    "notes/testing considerations": "notes",
    "testing considerations": "notes",
}

# What a changed cluster section is told by, and the changes that are only numbers, contents or metadata.
CLUSTER_HEADING = r"<h[23][^>]*id=\"ref_[^\"]*\"[^>]*>"
DIFF_WRAP = (r"<(ins|del)[^>]*>\s*(<h[23])", r"(</h[23]>)\s*</(ins|del)>")
DIFF_NUMBER = r"<(ins|del)[^>]*>\s*\[[\d.]+\]\s*</(ins|del)>"
DIFF_CONTENTS = r"<a\s[^>]*>\s*<(ins|del)[^>]*>\s*\d+(?:\.\d+)*\.?\s*</(ins|del)>"
DIFF_METADATA = r"<(ins|del)[^>]*>\s*(?:[0-9a-f]{8,40}|20\d{2}-\d{2}-\d{2}[\s\d:+-]*)\s*</(ins|del)>"
DIFF_TEXT = r"<(?:ins|del)[^>]*>(.*?)</(?:ins|del)>"
FEW_DIFFS = 10
