"""Words that stand near entities of a type: the larger lists, which a configuration may name instead of those in ``options``."""

# Fixed values.
SSN = """
ssn
ss#
ss #
soc sec
soc. sec.
social security
social security number
social security no
social security #
ssn:
social:
security:
tax id
tax identification
taxpayer id
taxpayer identification
tin
itin
individual taxpayer
ssa
social security administration
social security card
social security benefits
medicare number
"""
PHONE_NUMBER = """
phone
phone number
phone no
phone #
ph
ph#
tel
tel.
telephone
telephone number
mobile
mobile phone
mobile number
mobile #
cell
cell phone
cell number
cellphone
cellular
fax
fax number
fax #
facsimile
office
office phone
work
work phone
home
home phone
direct
direct line
extension
ext
ext.
contact
contact number
contact phone
call
reach
callback
call back
primary phone
secondary phone
alternate phone
emergency contact
emergency phone
intl
international
country code
area code
"""
BIRTHDATE = """
dob
d.o.b.
d.o.b
date of birth
birth date
birthdate
birthday
birth
born
born on
date born
birth:
dob:
age
years old
yrs old
year of birth
birth year
patient dob
member dob
insured dob
subscriber dob
dependent dob
applicant dob
claimant dob
"""
ACCOUNT_NUMBER = """
account
account number
account no
account #
acct
acct.
acct #
acct no
a/c
account:
bank
bank account
checking
checking account
savings
savings account
routing
routing number
aba
aba number
transit
transit number
iban
swift
swift code
bic
bic code
sort code
card number
card #
credit card
debit card
visa
mastercard
amex
american express
discover
brokerage
investment account
portfolio
portfolio number
securities
policy
policy number
policy #
claim
claim number
claim #
member id
member number
subscriber id
group number
group #
customer id
customer number
customer #
reference
reference number
ref
ref #
confirmation
confirmation number
order
order number
order #
invoice
invoice number
invoice #
"""
ADDRESS = """
address
addr
addr.
address:
street
street address
mailing
mailing address
physical
physical address
home
home address
residence
residential
residential address
business
business address
work
work address
office
office address
billing
billing address
shipping
shipping address
ship to
deliver to
delivery address
live at
lives at
located at
located
location
resides
resides at
residing
residing at
apt
apt.
apartment
unit
suite
ste
ste.
floor
fl
fl.
building
bldg
room
rm
po box
p.o. box
post office box
postal
postal address
zip
zip code
zipcode
postal code
city
state
county
country
province
region
"""
PERSON = """
name
mr
mrs
ms
miss
dr
prof
sir
madam
patient
client
customer
employee
applicant
member
resident
owner
tenant
beneficiary
policyholder
insured
claimant
defendant
plaintiff
witness
signatory
author
sender
recipient
contact
representative
guardian
spouse
dependent
full name
first name
last name
surname
given name
family name
middle name
maiden name
printed name
signature
signed by
authorized by
prepared by
submitted by
"""
# End of the fixed values.


def _lines(text: str) -> tuple[str, ...]:
    return tuple(x for x in text.split("\n") if x)


#: Lists by type; the dates' words serve BIRTHDATE and DATE alike where a configuration says so.
LISTS = {
    "SSN": _lines(SSN), "PHONE_NUMBER": _lines(PHONE_NUMBER), "BIRTHDATE": _lines(BIRTHDATE), "ACCOUNT_NUMBER": _lines(ACCOUNT_NUMBER), "ADDRESS": _lines(ADDRESS),
    "PERSON": _lines(PERSON),
}
