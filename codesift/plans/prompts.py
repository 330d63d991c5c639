"""Request texts sent to the model.

Fixed values: every string below must equal the original tool's wording so that
stored answers replay against identical requests.  They are data, assembled
into request columns by the operators; nothing here runs per row.
"""

from __future__ import annotations

import json

# ----------------------------------------------------------------- fixed values
# Models that take max_completion_tokens / reasoning_effort and no temperature (M2).
COMPLETION_TOKEN_MODELS = ["gpt-5", "gpt-5-mini"]
DEFAULT_MODEL = "gpt-4o"
SUMMARY_MODEL = "gpt-4o-mini"

# Operation names (M3).
OP_SELECT = "select-vuln-files"
OP_SUMMARY = "summarise-and-imports"
OP_GROUP = "group-subsets"
OP_SUGGEST = "suggest-pipelines"
OP_STAGE_PREFIX = "pipeline-stage-"

# Output budgets and temperatures.
SELECT_TEMPERATURE = 0.2
SUMMARY_TEMPERATURE = 0.2
SUMMARY_MAX_TOKENS = 200
GROUP_TEMPERATURE = 0.2
GROUP_MAX_TOKENS = 1500
SUGGEST_TEMPERATURE = 0.2
SUGGEST_MAX_TOKENS = 120
SCAN_MAX_TOKENS = 720

# The original tool's limits.  Only the chunk size is a default here; the others are passed by a
# caller who wants the original prompts.
SELECT_LIMIT = 30
FILES_PER_GROUPING_PROMPT = 60
FILES_PER_SUGGESTION = 8
# Paths per selection request: a repo with more gets several requests, whose answers are joined.
SELECT_BATCH = 200
DEFAULT_PIPELINE = "pipeline_injection"

SELECT_SYSTEM = "You are a senior security engineer specializing in MERN and Node.js audits."
SELECT_PROMPT_HEAD = (
    "Your task: Review the following list of file paths and select only those likely to contain vulnerabilities, secrets, or critical configuration logic.\n\n"
    "Guidelines (follow ALL):\n"
    "1. INCLUDE: backend controllers, route handlers, services, Database models, authentication logic, environment loaders, shell scripts, custom middleware.\n"
    "2. EXCLUDE: static assets, images, generated code, test files, docs (README / LICENSE / *.md), build artifacts.\n"
    "3. Return only the provided paths, focusing on the most risky ones.\n"
    "4. OUTPUT FORMAT: JSON array of strings ONLY - *no* keys, comments, or code fences. Do NOT wrap in triple backticks.\n"
    "5. EXACTLY reproduce the selected paths as they appear (do not modify slashes, case, etc.).\n\n"
    "Example output (for illustration only - do NOT repeat this text):\n"
    "[\n"
    "  \"backend/controllers/auth.js\",\n"
    "  \"backend/models/userModel.js\"\n"
    "]\n\n"
    "---\n"
    "FILES TO REVIEW:\n"
)
SELECT_REMAINDER = "\n… and {n} more files"

SUMMARY_SYSTEM = "You are a senior application security engineer. Return ONLY valid JSON, nothing else."
SUMMARY_PROMPT_HEAD = (
    "Return a JSON object with this structure:\n"
    '{"summary": "<2-3 sentence description>", "imports": ["<module1>", "<module2>"]}\n\n'
    "Requirements:\n"
    "- summary: Describe file purpose, key operations, and security behaviors\n"
    "- imports: List all imported modules/packages\n"
    "- Return ONLY valid JSON, no markdown, no extra text\n\n"
    "Example: {\"summary\": \"Handles user auth with JWT. Validates credentials and manages sessions.\", \"imports\": [\"express\", \"bcrypt\", \"jwt\"]}\n\n"
    "Code:\n```\n"
)
SUMMARY_PROMPT_TAIL = "\n```"

GROUP_SYSTEM = (
    "You are a senior security auditor and MERN full-stack architect. Return only a valid JSON array as output — "
    "no text, explanations, or comments. Each JSON object represents a logical functional subset of related files."
)
GROUP_INSTRUCTIONS = (
    "You are reviewing a MERN stack codebase for security and architectural consistency. "
    "Group the listed files into logical subsets based on their functional and security connections. \n\n"
    "Focus your grouping on:\n\n"
    "1. End-to-end data flows (Frontend → Backend → Database → Response)\n"
    "2. MVC relationships (Controller ↔ Model ↔ DB-Schema)\n"
    "3. Shared state and session logic (props, context, tokens, cookies)\n"
    "4. Authentication & authorization (login, token verification, access control)\n"
    "5. API endpoints and handlers (request routing, middleware, error handling)\n\n"
    "Guidelines:\n"
    "- Each subset = one cohesive functional unit or data flow.\n"
    "- Include both frontend and backend files that work together in the same subset\n"
    "- Group files that share security contexts (e.g., authentication logic)\n"
    "- Prefer 5-15 files per subset, though flexible if functionally justified.\n"
    "- Every file should be in at least one subset\n\n"
    "Return ONLY a JSON array where each element has the exact schema below. Do NOT include any surrounding prose, explanations, or markdown fences. Return raw JSON only.\n\n"
    "Schema (exact keys and types):\n"
    "- subset_id: string (e.g. 'subset-001')\n"
    "- file_paths: array of strings (each item must be an exact file path listed in the Files section)\n"
    "- reason: string (a single paragraph explaining why these files belong together)\n\n"
    "Example (must match this structure exactly):\n"
    "[\n"
    "  {\n"
    "    \"subset_id\": \"subset-001\",\n"
    "    \"file_paths\": [\n"
    "      \"frontend/components/LoginForm.jsx\",\n"
    "      \"frontend/pages/Login.jsx\",\n"
    "      \"frontend/context/AuthContext.jsx\",\n"
    "      \"backend/controllers/authController.js\",\n"
    "      \"backend/middleware/authMiddleware.js\",\n"
    "      \"backend/models/User.js\",\n"
    "      \"backend/routes/authRoutes.js\",\n"
    "      \"backend/utils/jwtHelper.js\",\n"
    "      \"backend/utils/passwordHash.js\"\n"
    "    ],\n"
    "    \"reason\": \"End-to-end authentication flow: frontend components (LoginForm, Login page, AuthContext) connect to backend routes and controller.\"\n"
    "  }\n"
    "]\n\n"
    "Important rules:\n"
    "- Do NOT wrap the JSON in markdown fences (```).\n"
    "- Do NOT add any text before or after the JSON.\n"
    "- Each file listed under file_paths must exactly match a path from the Files list.\n"
    "- Keep subset_id values unique within this response.\n"
)
GROUP_FILES_HEADER = "\n\nFiles:\n"
GROUP_ID_DEFAULT = "subset"
SUBSET_ID_FORMAT = "subset-%03d"

SUGGEST_SCHEMA = {
    "type": "array",
    "items": {
        "type": "string",
        "description": "Pipeline ID from the available pipelines list",
    },
    "description": "Array of pipeline IDs to run on this subset",
}
SUGGEST_SYSTEM_HEAD = (
    "You are a senior security auditor. Your task is to choose which analysis pipelines from the list below "
    "should be applied to a subset of code files.\n\nAvailable pipelines:\n"
)
SUGGEST_SYSTEM_TAIL = (
    "\n\nYou MUST respond with a JSON array of pipeline_id strings. The response must follow this schema:\n"
    + json.dumps(SUGGEST_SCHEMA, indent=2)
    + "\n\nIMPORTANT: Return ONLY the raw JSON array. Do NOT wrap it in markdown code blocks, backticks, or any other "
    "formatting. The response must be directly parseable as JSON.\n\n"
    'Example response: ["pipeline_injection", "pipeline_auth"]\n'
)
SUGGEST_USER_HEAD = "Here is the code subset to analyze:\n"
SUGGEST_USER_TAIL = "\n\nWhich pipelines should be applied to this subset? Return only the JSON array of pipeline IDs."
SUBSET_OMITTED = "… {n} more files omitted for brevity …"

FINDING_SCHEMA = {
    "type": "array",
    "items": {
        "type": "object",
        "properties": {
            "file_path": {"type": "string"},
            "code_snippet": {"type": "string"},
            "description": {"type": "string"},
            "vulnerability": {"type": "string"},
            "severity": {"type": "string", "enum": ["Low", "Medium", "High", "Critical"]},
            "confidence_level": {"type": "string", "enum": ["Low", "Medium", "High"]},
            "remediation": {"type": "string"},
        },
        "required": ["file_path", "description", "vulnerability", "severity", "confidence_level", "remediation"],
    },
}
SEVERITY_VALUES = ["Low", "Medium", "High", "Critical"]
CONFIDENCE_VALUES = ["Low", "Medium", "High"]
FINDING_REQUIRED = ["file_path", "description", "vulnerability", "severity", "confidence_level", "remediation"]

SCAN_SYSTEM_HEAD = "You are a senior security auditor.\n\n"
SCAN_SCHEMA_TEXT = (
    "\n\nYou MUST format your response as a JSON object with a 'vulnerabilities' key containing an array of vulnerability objects."
    "\nEach vulnerability object MUST follow this schema:\n" + json.dumps(FINDING_SCHEMA, indent=2)
)
SCAN_EXAMPLE_HEAD = "\n\nBelow is an example response. Use it as a reference only:\n\n"
SCAN_USER_HEAD = "```\n"
SCAN_USER_TAIL = "\n```"
RESPONSE_FORMAT_JSON = "json_object"  # sent as {"type": "json_object"}

LOCATE_THRESHOLD = 0.6
LOCATE_MAX_WINDOW = 5
# ---------------------------------------------------------------------------
