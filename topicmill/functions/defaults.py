"""Fixed values that results depend on."""

# The default stop-word list, one word per line.
STOPWORDS = """
xc
΄
xce
*
zip
xaf
%
!
purl
fri
>
.
type
xad
xb
owl
=
xbf
archiveformat
tar
@
tue
xd
{
xbe
]
"
<
url
xbc
skos
xaa
rdfs
,
;
xmlns
)
:
gnu
dc
/
#
`
rdf
string
label
^
sun
mon
}
xe
$
thu
wed
[
?
sat
(
'
xcf
dcterms
-
org
www
html
json
ttl
fn
xmlschema
xsd
http
float
th
""".split()

# Default limits, topic counts and report sizes.
NO_BELOW = 1
NO_ABOVE = 1.0
TOPIC_COUNTS = (2, 4, 8, 9, 10, 11, 12, 13, 14, 15, 16)
TERMS_PER_TOPIC = 100
LATENT_DIMENSIONS = 500
SPLIT_BYTES = 100_000_000
UNKNOWN_TOKEN_ID = -1
WEIGHT_EPSILON = 1e-12
MIN_TOPIC_WEIGHT = 0.01
